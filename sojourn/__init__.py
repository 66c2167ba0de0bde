"""Patient-journey analytics as Spark DataFrame operators."""

from sojourn.params import Params

__all__ = ["Params"]
