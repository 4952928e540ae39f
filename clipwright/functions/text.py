"""Text as JSON documents hold it."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def ascii_only(json: Column) -> Column:
    """A JSON text with all that is not ASCII as escapes of four hex digits, pairs of them beyond the first 65,536."""
    unit = F.regexp_extract_all(F.hex(F.encode(json, "UTF-16BE")), F.lit("(.{4})"), F.lit(1))
    spelled = F.transform(unit, lambda u: F.when(u < "0080", F.char(F.conv(u, 16, 10).cast("int"))).otherwise(F.concat(F.lit("\\u"), F.lower(u))))
    return F.when(json.rlike(r"[^\x00-\x7F]"), F.concat_ws("", spelled)).otherwise(json)
