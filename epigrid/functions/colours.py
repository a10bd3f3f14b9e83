"""Heat-map colours."""

from pyspark.sql import Column, functions as F

from epigrid.constants import HEAT_RAMP


def ramp_colour(intensity: Column) -> Column:
    """Colour on the piecewise-linear heat ramp as `#rrggbb`; every channel is cut to a whole number."""
    colour = F.lit(HEAT_RAMP[-1][1])
    for (low, low_colour), (high, high_colour) in reversed(list(zip(HEAT_RAMP, HEAT_RAMP[1:]))):
        t = (intensity - F.lit(low)) / F.lit(high - low)
        parts = [F.lit("#")]
        for at in (1, 3, 5):
            a, b = int(low_colour[at : at + 2], 16), int(high_colour[at : at + 2], 16)
            channel = (F.lit(float(a)) * (F.lit(1.0) - t) + F.lit(float(b)) * t).cast("int")
            parts.append(F.lpad(F.lower(F.hex(channel)), 2, "0"))
        colour = F.when(intensity <= F.lit(high), F.concat(*parts)).otherwise(colour)
    return colour
