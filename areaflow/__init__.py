"""areaflow: public-transport delay and area-disadvantage analytics as Spark DataFrame functions."""

__version__ = "0.1.0"
