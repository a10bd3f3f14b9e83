"""Fixed values shared by the operators and by their SQL checks."""

import math

# Planar degrees to metres and square degrees to square kilometres.
M_PER_DEG = 111000.0
SQKM_PER_SQDEG = 11988.0

# Case severities, mildest first, and those counted as severe.
SEVERITIES = ("DF", "DHF", "DSS")
SEVERE = ("DHF", "DSS")

# Risk tiers and their radius in metres, nearest first.
RISK_TIERS = (("RED", 500), ("ORANGE", 1000), ("YELLOW", 2000))

# Tier styles (colour, fill opacity), the style of an unknown tier and the heat ramp.
TIER_STYLES = {"RED": ("#e74c3c", 0.45), "ORANGE": ("#e67e22", 0.30), "YELLOW": ("#f1c40f", 0.18)}
RADIUS_STYLES = {radius: TIER_STYLES[tier] for tier, radius in RISK_TIERS}
UNKNOWN_STYLE = ("#999999", 0.3)
HEAT_RAMP = ((0.0, "#ffffb2"), (0.25, "#fecc5c"), (0.50, "#fd8d3c"), (0.75, "#f03b20"), (1.0, "#bd0026"))

# A buffer is a regular polygon with this many sides, inscribed in the circle of the given radius.
SIDES = 32
VERTICES = tuple((math.cos(2 * math.pi * k / SIDES), math.sin(2 * math.pi * k / SIDES)) for k in range(SIDES))
NORMALS = tuple(
    (math.cos((2 * k + 1) * math.pi / SIDES), math.sin((2 * k + 1) * math.pi / SIDES)) for k in range(SIDES)
)
APOTHEM = math.cos(math.pi / SIDES)
HALF_SIDE = math.sin(math.pi / SIDES)
UNIT_AREA = 0.5 * SIDES * math.sin(2 * math.pi / SIDES)

# A side is broadcast only after a count shows that it has at most this many rows.
BROADCAST_ROWS = 200_000
# A join key with more rows than this on the large side is split into several tasks.
HOT_ROWS = 1_000_000
# Rows of the large side per task of a distance join; at some hundred facilities in reach a task makes some million pairs.
PAIR_ROWS = 20_000
