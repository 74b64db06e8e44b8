from cdclake.functions.scalar import percent_of, register_functions
from cdclake.functions.types import map_source_type, parse_source_type, spark_type_name

__all__ = ["map_source_type", "parse_source_type", "percent_of", "register_functions", "spark_type_name"]
