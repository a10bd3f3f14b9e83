import random

import pytest

DOC = "doc_id long, text string, lang string, score double, length long, bits string, anchors string, at int, mark string"


def frame(spark, rows):
    """Documents with further columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "en", 0.5, 7, "b", "a", 1, "m") for i, t in rows], DOC)


def sentence(rng, n):
    return " ".join("".join(rng.choice("abdeinorst") for _ in range(rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="session")
def edge_rows():
    """Null, empty, blank, very long and repeated texts, null and repeated ids."""
    rng = random.Random(1)
    long = "\n".join(sentence(rng, 40) for _ in range(300))
    return [
        (1, sentence(rng, 30)), (2, None), (3, ""), (3, ""), (4, " \n\t \x0b "), (5, long), (6, "x" * 5000), (None, "no id here at all"),
        (None, None), (7, "Ünïcödé 　 wörds \U0001f600 \x00 and <s> <|endoftext|> ▁▁"), (8, "of " * 400), (9, long[:3000]),
    ]
