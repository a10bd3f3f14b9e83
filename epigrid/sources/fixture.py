"""The small surveillance fixture: 30 cases, 15 hospitals, 10 schools, 3 provinces."""

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from epigrid.constants import RISK_TIERS
from epigrid.sources import schemas

# The rows of the training data set.
_HOSPITALS = """
1|Siriraj Hospital|Bangkok|Bangkok Noi|100.4856|13.7590
2|Ramathibodi Hospital|Bangkok|Ratchathewi|100.5385|13.7649
3|King Chulalongkorn Memorial|Bangkok|Pathum Wan|100.5347|13.7312
4|Bamrasnaradura Infectious Diseases|Bangkok|Mueang Nonthaburi|100.5230|13.8480
5|Queen Sirikit National Institute|Bangkok|Ratchathewi|100.5340|13.7680
6|Nopparat Rajathanee Hospital|Bangkok|Khannayao|100.6780|13.7870
7|Charoen Krung Pracharak Hospital|Bangkok|Bang Kho Laem|100.5080|13.6930
8|Taksin Hospital|Bangkok|Thon Buri|100.4870|13.7190
9|Maharaj Nakorn Chiang Mai|Chiang Mai|Mueang Chiang Mai|98.9720|18.7880
10|Chiang Mai Ram Hospital|Chiang Mai|Mueang Chiang Mai|98.9870|18.7920
11|Nakornping Hospital|Chiang Mai|Mae Rim|98.9580|18.8900
12|San Sai Hospital|Chiang Mai|San Sai|99.0320|18.8370
13|Chiang Rai Prachanukroh Hospital|Chiang Rai|Mueang Chiang Rai|99.8310|19.9100
14|Overbrook Hospital|Chiang Rai|Mueang Chiang Rai|99.8280|19.9050
15|Mae Sai Hospital|Chiang Rai|Mae Sai|99.8760|20.4280
"""
_CASES = """
1|8|F|2024-06-15|DF|100.5530|13.7230
2|25|M|2024-06-18|DF|100.5560|13.7210
3|12|F|2024-06-22|DHF|100.5510|13.7250
4|45|M|2024-07-01|DF|100.5580|13.7200
5|6|M|2024-07-05|DSS|100.5540|13.7240
6|33|F|2024-07-08|DF|100.5520|13.7220
7|18|M|2024-07-12|DHF|100.5570|13.7190
8|9|F|2024-07-15|DF|100.5500|13.7260
9|55|M|2024-07-20|DF|100.5550|13.7235
10|14|F|2024-08-01|DHF|100.5525|13.7215
11|28|M|2024-08-10|DF|100.5590|13.7180
12|7|F|2024-08-15|DF|100.5535|13.7245
13|22|M|2024-07-10|DF|100.5580|13.7640
14|10|F|2024-07-15|DHF|100.5610|13.7620
15|38|M|2024-07-22|DF|100.5570|13.7660
16|5|F|2024-08-01|DSS|100.5600|13.7650
17|42|M|2024-08-08|DF|100.5590|13.7630
18|15|F|2024-08-12|DF|100.5620|13.7610
19|31|M|2024-08-20|DHF|100.5575|13.7645
20|19|F|2024-09-01|DF|100.5605|13.7635
21|20|M|2024-07-05|DF|98.9820|18.7870
22|11|F|2024-07-12|DHF|98.9780|18.7900
23|35|M|2024-07-25|DF|98.9850|18.7850
24|8|F|2024-08-05|DF|98.9800|18.7880
25|48|M|2024-08-18|DSS|98.9830|18.7860
26|16|F|2024-09-02|DF|98.9810|18.7890
27|30|M|2024-08-01|DF|99.8800|20.4300
28|13|F|2024-08-15|DHF|99.8780|20.4320
29|52|M|2024-09-01|DF|99.8820|20.4280
30|9|F|2024-09-10|DF|99.8790|20.4310
"""
_SCHOOLS = """
1|Wat Khlong Toei School|Khlong Toei|100.5545|13.7225
2|Khlong Toei Wittaya School|Khlong Toei|100.5510|13.7195
3|Sukhumvit Pattana School|Watthana|100.5620|13.7270
4|Din Daeng Wittaya School|Din Daeng|100.5590|13.7670
5|Ratchadaphisek Wittayalai School|Din Daeng|100.5640|13.7600
6|Huai Khwang School|Huai Khwang|100.5730|13.7650
7|Satri Witthaya School|Dusit|100.5130|13.7720
8|Benchama Rajalai School|Phra Nakhon|100.5010|13.7530
9|Suankularb Wittayalai School|Phra Nakhon|100.4960|13.7440
10|Triam Udom Suksa School|Pathum Wan|100.5310|13.7370
"""
# code, name, and the box x0, y0, x1, y1
_PROVINCES = """
10|Bangkok|100.3270|13.5800|100.9380|13.9550
50|Chiang Mai|98.0600|18.1000|99.5400|19.7600
57|Chiang Rai|99.2000|19.5000|100.6000|20.5000
"""


def fixture_tables(spark: SparkSession) -> dict[str, DataFrame]:
    """The fixture as DataFrames, under the names the operators use."""
    hospitals = [(int(i), n, p, d, float(x), float(y)) for i, n, p, d, x, y in _rows(_HOSPITALS)]
    cases = [
        (int(i), int(age), sex, date.fromisoformat(day), severity, float(x), float(y))
        for i, age, sex, day, severity, x, y in _rows(_CASES)
    ]
    schools = [(int(i), n, d, float(x), float(y)) for i, n, d, x, y in _rows(_SCHOOLS)]
    regions = []
    for code, name, *box in _rows(_PROVINCES):
        x0, y0, x1, y1 = map(float, box)
        ring = [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]
        regions.append((code, name, ring, x0, y0, x1, y1))
    return {
        "hospitals": spark.createDataFrame(hospitals, schemas.HOSPITALS),
        "cases": spark.createDataFrame(cases, schemas.CASES),
        "schools": spark.createDataFrame(schools, schemas.SCHOOLS),
        "regions": spark.createDataFrame(regions, schemas.REGIONS),
        "risk_tiers": risk_tiers(spark),
    }


def risk_tiers(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(RISK_TIERS), schemas.TIERS)


def _rows(text: str) -> list[list[str]]:
    return [line.split("|") for line in text.strip().splitlines()]
