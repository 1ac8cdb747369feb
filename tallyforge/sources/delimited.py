"""CSV in and out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Paths = str | Sequence[str]


def read_csv(spark: SparkSession, path: Paths, schema: T.StructType | str, header: bool = True) -> DataFrame:
    """Scan with a declared schema: no inference pass, and the schema's names win over the header's."""
    return spark.read.schema(schema).option("enforceSchema", True).csv(_as_paths(path), header=header)


def read_csv_inferred(
    spark: SparkSession,
    path: Paths,
    names: Sequence[str] | None = None,
    header: bool = False,
    sampling_ratio: float | None = None,
) -> DataFrame:
    """Scan with inferred types, optionally renaming every column by position.

    Inference reads the data once more; ``sampling_ratio`` bounds that pass on large inputs.
    """
    df = spark.read.csv(_as_paths(path), header=header, inferSchema=True, samplingRatio=sampling_ratio)
    return df.toDF(*names) if names else df


#: Holds the text of a malformed line while it is read; no column may have this name.
_LINE = "_malformed"


def read_csv_marked(spark: SparkSession, path: Paths, schema: T.StructType | str, header: bool = True) -> DataFrame:
    """All lines with a declared schema, and in ``problems`` what is wrong with each: ``array<string>``, empty for good lines.

    A line is wrong if it has too few or too many fields (``fields``) or a field that is not of its type (the name of the
    column). Fields that can be read are kept, others are null; ``line`` is the text of a wrong line, else null. An empty
    field is a null of any type. Split with ``split_csv``.
    """
    struct = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    wide = T.StructType([*struct, T.StructField(_LINE, T.StringType())])
    reader = spark.read.schema(wide).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _LINE).option("enforceSchema", True)
    # Without pruning, as the reader only checks the columns that it reads.
    rows = reader.option("columnPruning", False).csv(_as_paths(path), header=header)
    names = [f"f{i}" for i in range(len(struct))]
    fields = F.from_csv(F.col(_LINE), ", ".join(f"{n} string" for n in names))
    told = rows.withColumn("_fields", fields)
    wrong = [
        F.when(F.col(f"_fields.f{i}").isNotNull() & F.col(field.name).isNull(), F.lit(field.name)) for i, field in enumerate(struct)
    ]
    # Quoted fields, the last one perhaps not closed, may hold commas.
    bare = F.regexp_replace(F.col(_LINE), r'"(?:[^"\\]|\\.)*(?:"|$)', "q")
    count = F.when(F.size(F.split(bare, ",")) != len(struct), F.lit("fields"))
    problems = F.when(F.col(_LINE).isNull(), F.array().cast("array<string>")).otherwise(F.array_compact(F.array(count, *wrong)))
    named = F.when(F.col(_LINE).isNotNull() & (F.size(problems) == 0), F.array(F.lit("line"))).otherwise(problems)
    return told.select(*[F.col(f.name) for f in struct], F.col(_LINE).alias("line"), named.alias("problems"))


def split_csv(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows with the columns of the schema, and wrong lines as ``line, problems``."""
    good = marked.filter(F.size("problems") == 0).drop("line", "problems")
    return good, marked.filter(F.size("problems") > 0).select("line", "problems")


def write_csv(df: DataFrame, path: str, header: bool = True, files: int | None = None) -> None:
    """Replace ``path`` with ``df``, in as many files as ``files`` says, or one for each task.

    The number is always obeyed: a single file is written by a single task, whatever its size.
    """
    shaped = df.repartition(files) if files else df
    shaped.write.mode("overwrite").csv(path, header=header)


def _as_paths(path: Paths) -> str | list[str]:
    return path if isinstance(path, str) else list(path)
