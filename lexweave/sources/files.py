"""File scans and the keys that live in file paths."""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexweave.functions.types import quoted


def read_merged(
    spark: SparkSession, path: str, kind: str = "parquet", schema: T.StructType | None = None
) -> DataFrame:
    """Scan a folder or glob whose files carry different columns.

    Without a schema Spark reads every file's footer to merge them; with very
    many files pass the declared schema, and absent columns are null. Where the
    types of a column differ between files, it gets the narrowest type that holds
    them all (``read_mixed``).
    """
    reader = spark.read.format(kind)
    if schema is not None:
        return reader.schema(schema).load(path)
    if kind == "csv":
        return reader.option("header", "true").load(path)
    try:
        return reader.option("mergeSchema", "true").load(path)
    except (PySparkException, Py4JJavaError) as exc:
        if kind != "parquet" or not _types_differ(exc):
            raise
        return read_mixed(spark, path)


def _types_differ(exc: Exception) -> bool:
    """Whether merging footers failed for their types: on the driver or, as a plain Java error, in a task."""
    return "CANNOT_MERGE" in str(exc)


def read_mixed(spark: SparkSession, path: str) -> DataFrame:
    """Scan Parquet files whose types differ: each group of files with its own schema, then widened.

    Whole numbers of any width widen to the widest, with fractions to double, and anything
    else that differs to string, nested values as JSON. No row is lost and no value is nulled.
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    paths = found.option("pathGlobFilter", "*.parquet").load(path).select("path").collect()
    # Folder names that are columns stay so where the path is one folder.
    root = {} if any(c in path for c in "*?[{") else {"basePath": path}
    groups = schema_groups(spark, sorted(r["path"] for r in paths), root)
    frames = [spark.read.options(**root).schema(schema).parquet(*files) for schema, files in groups]
    names: dict[str, str] = {}
    kinds: dict[str, list[T.DataType]] = {}
    for frame in frames:
        for field in frame.schema.fields:
            names.setdefault(field.name.lower(), field.name)
            kinds.setdefault(field.name.lower(), []).append(field.dataType)
    wide = {key: widest(found_kinds) for key, found_kinds in kinds.items()}
    aligned = [
        frame.select(*[_widened(f, wide[f.name.lower()]).alias(names[f.name.lower()]) for f in frame.schema.fields])
        for frame in frames
    ]
    return union_all(aligned).select(*[quoted(n) for n in names.values()])


def schema_groups(
    spark: SparkSession, files: list[str], options: dict[str, str] | None = None
) -> list[tuple[T.StructType, list[str]]]:
    """Files in few groups whose footers agree on every type, with their merged schemas.

    Halves whose footers Spark can merge are read in one job, so files cost one by one only
    around those that differ from their neighbours.
    """
    try:
        merged = spark.read.options(**(options or {})).option("mergeSchema", "true").parquet(*files).schema
        return [(merged, files)]
    except (PySparkException, Py4JJavaError) as exc:
        if len(files) == 1 or not _types_differ(exc):
            raise
    half = len(files) // 2
    groups: list[tuple[T.StructType, list[str]]] = []
    for schema, members in schema_groups(spark, files[:half], options) + schema_groups(spark, files[half:], options):
        for i, (known, others) in enumerate(groups):
            types = {f.name.lower(): f.dataType for f in known.fields}
            if all(types.get(f.name.lower(), f.dataType) == f.dataType for f in schema.fields):
                new = [f for f in schema.fields if f.name.lower() not in types]
                groups[i] = (T.StructType([*known.fields, *new]), others + members)
                break
        else:
            groups.append((schema, members))
    return groups


# From narrow to wide: each holds the values of those before it.
WHOLE = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())


def widest(kinds: Sequence[T.DataType]) -> T.DataType:
    """The narrowest type of the lattice that holds values of all the types."""
    distinct = list(dict.fromkeys(kinds))
    if len(distinct) == 1:
        return distinct[0]
    if all(k in WHOLE for k in distinct):
        return max(distinct, key=WHOLE.index)
    if all(isinstance(k, T.NumericType) for k in distinct):
        return T.DoubleType()
    if all(isinstance(k, (T.DateType, T.TimestampType)) for k in distinct):
        return T.TimestampType()
    return T.StringType()


def _widened(field: T.StructField, kind: T.DataType) -> Column:
    column = quoted(field.name)
    if field.dataType == kind:
        return column
    if isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(column)
    return column.cast(kind)


def read_folder(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Scan a whole-table entity."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_json(
    spark: SparkSession, path: str, schema: T.StructType | str, multi_line: bool = False
) -> DataFrame:
    """Scan landed JSON with a declared schema, so no pass is spent on inference."""
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def read_if_present(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame | None:
    """A store's files, or nothing before the first write.

    Without a declared schema the files' columns are merged, so that a column
    only some of them have is not lost when they are rewritten.
    """
    try:
        return read_merged(spark, path, schema=schema)
    except AnalysisException as exc:
        if exc.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def listed(spark: SparkSession, pattern: str) -> list[str]:
    """Files and folders that a pattern names, in the session's file systems."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(s.getPath().toString() for s in found or [])


def complete(spark: SparkSession, pattern: str) -> list[str]:
    """Folders whose job has committed, of those that a pattern names."""
    return [p.removesuffix("/_SUCCESS") for p in listed(spark, f"{pattern}/_SUCCESS")]


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder with all it holds."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Read back a standard-model table that ``write_table`` wrote."""
    return spark.read.parquet(f"{root}/{name.lower()}")


def read_raw(spark: SparkSession, root: str, org: str, project_type: int) -> dict[str, DataFrame]:
    """The raw sets of one tenant and project type, as far as they are there.

    ``root`` holds the case system's folders, one file per project and entity.
    """
    projects = f"{root}/{org}/{project_type}/*"
    paths = {
        "contact": f"{root}/{org}/contact",
        "projecttype": f"{root}/{org}/projecttype",
        "project": f"{projects}/project.parquet",
        "intake": f"{projects}/form/intake.parquet",
        "casesummary": f"{projects}/form/casesummary.parquet",
        "meds": f"{projects}/collections/meds.parquet",
    }
    frames = {name: read_if_present(spark, path) for name, path in paths.items()}
    return {name: frame for name, frame in frames.items() if frame is not None}


def read_phase_files(spark: SparkSession, path: str, root: str = "cms") -> DataFrame:
    """Phase changes kept as one file each; the keys come from the file's path."""
    keys = case_path_keys(file_path(), root)
    return spark.read.schema("project_id bigint, phase string").parquet(path).select(
        keys["org_id"].cast("bigint").alias("org_id"),
        keys["project_type_id"].alias("project_type_id"),
        "project_id",
        keys["event_ts"].alias("event_ts"),
        "phase",
    )


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames, columns by name, absent ones null."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first


def union_as(frames: Sequence[DataFrame], schema: dict[str, str]) -> DataFrame:
    """Union files whose types conflict: each is cast to one declared schema first."""
    aligned = []
    for frame in frames:
        present = {c.lower() for c in frame.columns}
        columns = {
            n: quoted(n).try_cast(t) if n.lower() in present else F.lit(None).cast(t)
            for n, t in schema.items()
        }
        aligned.append(frame.select(*[c.alias(n) for n, c in columns.items()]))
    return union_all(aligned)


def file_path() -> Column:
    return F.col("_metadata.file_path")


def _part(path: Column, pattern: str, group: int) -> Column:
    """A path part, null where the path has another layout."""
    return F.nullif(F.regexp_extract(path, pattern, group), F.lit(""))


def case_path_keys(path: Column, root: str = "cms") -> dict[str, Column]:
    """Keys in a case-system path below the folder ``root``.

    ``{org}/contact/…``, ``{org}/projecttype/…``, ``{org}/{type}/{project}/project.parquet``,
    ``{org}/{type}/{project}/{section}/{entity}.parquet`` and
    ``{org}/{type}/{project}/phases/{event millis}.parquet``.
    """
    base = rf"(?:^|/){root}/([^/]+)"
    project = base + r"/([0-9]+)/([^/]+)"
    section = project + r"/([^/]+)/([^/]+)\.parquet$"
    whole = base + r"/(contact|projecttype)/"
    is_phase = _part(path, section, 4) == "phases"
    leaf = _part(path, section, 5)
    return {
        "org_id": _part(path, base + "/", 1),
        "project_type_id": _part(path, project + "/", 2).try_cast("bigint"),
        "project_id": _part(path, project + "/", 3).try_cast("bigint"),
        "section": F.coalesce(
            _part(path, section, 4), F.when(path.rlike(project + "/project\\.parquet$"), "core"),
            F.when(path.rlike(whole), "core"),
        ),
        "entity": F.coalesce(
            F.when(is_phase, "phases").otherwise(leaf),
            F.when(path.rlike(project + "/project\\.parquet$"), "project"),
            _part(path, whole, 2),
        ),
        "event_ts": F.when(is_phase, leaf).try_cast("bigint"),
    }


def lead_path_keys(path: Column, root: str = "crm") -> dict[str, Column]:
    """Keys in a lead-system path: ``{root}/{org}/{model}/{id}.parquet``."""
    pattern = rf"(?:^|/){root}/([^/]+)/([^/]+)/([^/]+)\.parquet$"
    leaf = _part(path, pattern, 3)
    return {
        "org": _part(path, pattern, 1),
        "model": F.lower(_part(path, pattern, 2)),
        "record_id": leaf.try_cast("bigint"),
        "is_bulk": leaf.startswith("bulk_"),
    }
