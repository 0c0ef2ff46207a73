"""Bronze layer: JSON text in, typed records out, and bounded JSON batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from editpulse.operators.quality import LINES, bracketed
from editpulse.schemas import BRONZE
from editpulse.session import stored
from editpulse.sources.arrays import array_records, heads, of_files


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the matching files with the file they came from."""
    return spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"))


def parse_records(lines: DataFrame, *, value_col: str = "value",
                  schema: T.StructType = BRONZE, keep: tuple[str, ...] = ()) -> DataFrame:
    """Records of each line: a JSON array, or one object. Bad lines yield none.

    A parser stops at the end of the first value. Each line is therefore parsed
    inside one more pair of brackets, which turns anything after the value into
    an error, and must give exactly one value.
    ``keep`` names columns of ``lines`` to carry along, such as the file.
    """
    text = F.btrim(F.col(value_col), F.lit(" \t\r\n"))
    wrapped = F.concat(F.lit("["), text, F.lit("]"))
    is_array = text.startswith("[") & text.endswith("]")
    is_object = text.startswith("{") & text.endswith("}")
    # Two steps, so that a line is parsed once although its result is used twice.
    parsed = lines.select(
        *keep,
        F.when(is_array, F.from_json(wrapped, T.ArrayType(T.ArrayType(schema)))).alias("_arrays"),
        F.when(is_object, F.from_json(wrapped, T.ArrayType(schema))).alias("_objects"))
    records = F.when(F.size("_arrays") == 1, F.col("_arrays")[0]).when(
        F.size("_objects") == 1, F.col("_objects"))
    return (parsed.select(*keep, F.explode(records).alias("_r"))
            .filter("_r is not null").select(*keep, "_r.*"))


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """Records of lines, one-line arrays and arrays that span lines, each file read
    once the way it begins; none is read twice or left out. Arrays are cut into
    records by all tasks that read a part of them."""
    found = stored(heads(spark, path), "file-heads")
    candidates = bracketed(found)
    by_line = found.filter(LINES)
    if not candidates:
        return parse_records(of_files(read_lines(spark, path), [r.file for r in by_line.select("file").collect()]))
    records, arrays = array_records(spark, path, candidates, BRONZE)
    by_line = by_line.join(arrays, "file", "left_anti")
    lines = of_files(read_lines(spark, path), [r.file for r in by_line.select("file").collect()])
    return records.filter("r IS NOT NULL").select("r.*").unionByName(parse_records(lines))


def write_batches(df: DataFrame, path: str, *, batch_size: int = 100_000,
                  mode: str = "append") -> None:
    """Newline-delimited JSON files of at most ``batch_size`` records. The
    commit protocol makes the whole write visible or none of it."""
    df.write.mode(mode).option("maxRecordsPerFile", batch_size).json(path)
