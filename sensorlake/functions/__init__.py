from sensorlake.functions.expressions import (
    clamp,
    reading,
    sigma_band,
    stable_round,
    utc_day,
    z_score,
)

__all__ = ["clamp", "reading", "sigma_band", "stable_round", "utc_day", "z_score"]
