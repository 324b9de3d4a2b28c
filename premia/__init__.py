"""Motor-insurance pricing analytics expressed as Spark DataFrame jobs."""

from premia.settings import Settings

__all__ = ["Settings"]
