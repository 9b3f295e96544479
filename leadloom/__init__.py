"""leadloom: contact-lead analytics as Spark DataFrame jobs."""

from leadloom.params import Params

__all__ = ["Params"]
