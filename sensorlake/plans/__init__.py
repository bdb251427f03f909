from sensorlake.plans import jobs

__all__ = ["jobs"]
