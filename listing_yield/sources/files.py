"""File sources and sinks (S1, S2, S7-S14) for the unified listing table."""

from __future__ import annotations

import csv
import io
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from ..session import materialize

_STRING = T.StringType()
_DOUBLE = T.DoubleType()
_INT = T.IntegerType()

_TYPES = {
    "fecha_scraping": T.TimestampType(),
    "precio_valor": _DOUBLE, "expensas_valor": _DOUBLE, "latitud": _DOUBLE, "longitud": _DOUBLE,
    "sup_total_m2": _DOUBLE, "sup_cubierta_m2": _DOUBLE, "precio_m2": _DOUBLE,
    "comuna": _INT, "ambientes": _INT, "dormitorios": _INT, "banos": _INT, "cocheras": _INT,
    "antiguedad_anios": _INT, "es_a_estrenar": _INT,
}


def listing_schema(extra: Sequence[tuple[str, T.DataType]] = ()) -> T.StructType:
    """The unified 55-column schema (declared, never inferred), plus optional extra columns."""
    fields = [T.StructField(c, _TYPES.get(c, _INT if c in K.FLAG_COLUMNS else _STRING), True)
              for c in K.SCHEMA_COLUMNS]
    fields += [T.StructField(n, t, True) for n, t in extra]
    return T.StructType(fields)


LISTING_SCHEMA = listing_schema()


def project_to_schema(df: DataFrame, schema: T.StructType = LISTING_SCHEMA) -> DataFrame:
    """Columns in schema order, missing ones as typed NULLs, extra ones dropped."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schema.fields])


def with_default_flags(df: DataFrame, flags: Sequence[str] = K.MODEL_FLAGS) -> DataFrame:
    """Absent flag columns become 0."""
    return df.withColumns({c: F.lit(0) for c in flags if c not in df.columns})


BAD_RECORD = "_registro_malo"


def read_csv(spark: SparkSession, paths, schema: T.StructType = LISTING_SCHEMA, multi_line: bool = True,
             bad_records: bool = False) -> DataFrame:
    """Header, UTF-8 (a BOM is skipped), quoted text with embedded commas/newlines/quotes.

    With ``multi_line`` a file is one task, whatever its size: write many bounded files, or pass False for files
    known to hold no line feed inside a field (those are split).  ``bad_records`` adds the text of each record that
    doesn't fit the schema as ``_registro_malo`` (NULL for good records).
    """
    if bad_records:
        schema = T.StructType([*schema.fields, T.StructField(BAD_RECORD, T.StringType(), True)])
    return (spark.read.schema(schema)
            .options(header=True, multiLine=multi_line, escape='"', quote='"', encoding="UTF-8", mode="PERMISSIVE",
                     columnNameOfCorruptRecord=BAD_RECORD)
            .csv(paths))


def list_files(spark: SparkSession, folder: str) -> list[str]:
    """Paths of a folder's files (Hadoop file system); an absent folder has none, any other failure is raised."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    return sorted(s.getPath().toString() for s in fs.listStatus(path))


HEADER_BYTES = 1 << 16


def csv_header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """Column names of a CSV file, from its first ``HEADER_BYTES`` bytes; empty for an empty file."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    stream = at.getFileSystem(conf).open(at)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(at)
    stream = codec.createInputStream(stream) if codec else stream
    try:
        head = bytes(stream.readNBytes(HEADER_BYTES))
    finally:
        stream.close()
    rows = csv.reader(io.StringIO(head.decode("utf-8-sig", "replace").replace("\0", " ")))
    return tuple(x.strip() for x in next(rows, []))


def csv_groups(spark: SparkSession, paths: Sequence[str], schema: T.StructType) -> tuple[dict, list[str]]:
    """Paths by header (empty files left out), and the paths whose header names no column of the schema."""
    groups: dict[tuple[str, ...], list[str]] = {}
    for p in paths:
        groups.setdefault(csv_header(spark, p), []).append(p)
    groups.pop((), None)  # files without a byte
    strange = [h for h in groups if not set(h) & set(schema.names)]
    return groups, [p for h in strange for p in groups.pop(h)]


def header_schema(header: Sequence[str], schema: T.StructType) -> T.StructType:
    """The schema's columns in a header's order; names that it lacks, and repeated ones, are texts to be dropped."""
    known, fields = {f.name: f for f in schema.fields}, []
    for i, name in enumerate(header):
        fields.append(known.pop(name, None) or T.StructField(f"_columna_{i}", _STRING, True))
    return T.StructType(fields)


def read_snapshots(spark: SparkSession, folder: str, schema: T.StructType = LISTING_SCHEMA,
                   exclude_prefixes: Sequence[str] = ("_checkpoint", "dataset_maestro"),
                   bad_records: bool = False) -> DataFrame:
    """Every CSV (plain or ``.csv.gz``) *and* Parquet snapshot in a folder (names with excluded prefixes skipped),
    union by name.

    CSV files may have their columns in any order, lack some (NULL) or have others (dropped): files of equal header are
    one scan. A malformed CSV record keeps its row (``bad_records`` shows its text). A Parquet file that can't be read
    and a CSV file without any known column are skipped; ``snapshot_status`` names each file's state.
    """
    paths = snapshot_paths(spark, folder, exclude_prefixes)
    names = [*schema.names, *([BAD_RECORD] if bad_records else [])]
    frames = []
    for header, own in csv_groups(spark, paths["csv"], schema)[0].items():
        part = read_csv(spark, own, header_schema(header, schema), bad_records=bad_records)
        frames.append(part.select(*[c for c in names if c in part.columns]))
    if paths["parquet"]:
        frames.append(spark.read.schema(schema).option("ignoreCorruptFiles", True).parquet(*paths["parquet"]))
    if not frames:
        return spark.createDataFrame([], schema)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    full = T.StructType([*schema.fields, T.StructField(BAD_RECORD, _STRING, True)]) if BAD_RECORD in out.columns else schema
    return project_to_schema(out, full)


def snapshot_paths(spark: SparkSession, folder: str,
                   exclude_prefixes: Sequence[str] = ("_checkpoint", "dataset_maestro")) -> dict[str, list[str]]:
    names = [(p, p.rsplit("/", 1)[-1]) for p in list_files(spark, folder)]
    names = [(p, n) for p, n in names if not n.startswith(tuple(exclude_prefixes))]
    ends = {"csv": (".csv", ".csv.gz"), "parquet": ".parquet"}
    return {ext: [p for p, n in names if n.endswith(end)] for ext, end in ends.items()}


def unreadable_snapshots(spark: SparkSession, folder: str, schema: T.StructType = LISTING_SCHEMA,
                         exclude_prefixes: Sequence[str] = ("_checkpoint", "dataset_maestro")) -> DataFrame:
    """T5 for S2: (archivo) of each Parquet snapshot that gives no row: damaged files, which ``read_snapshots`` skips,
    and empty ones."""
    paths = snapshot_paths(spark, folder, exclude_prefixes)["parquet"]
    if not paths:
        return spark.createDataFrame([], "archivo string")
    known = spark.createDataFrame([(p.rsplit("/", 1)[-1],) for p in paths], "archivo string")
    read = (spark.read.schema(schema).option("ignoreCorruptFiles", True).parquet(*paths)
            .groupBy(F.col("_metadata.file_name").alias("archivo")).agg(F.count(F.lit(1)).alias("n")))
    return known.join(read, "archivo", "left_anti")


STATUS = ("archivo string, formato string, filas long, filas_esperadas long, filas_malas long, estado string, "
          "error string")
FOOTER_BYTES = 16 << 20  # a Parquet file without rows is its footer


def _file_name() -> F.Column:
    return F.col("_metadata.file_name")


def _csv_status(spark: SparkSession, header: Sequence[str], paths: list[str], schema: T.StructType) -> DataFrame:
    own = header_schema(header, schema)
    rows = read_csv(spark, paths, own, bad_records=True)
    values = F.xxhash64(*[F.col(f"`{f.name}`") for f in own.fields]).alias("h")  # so that every field is parsed
    texts = [F.col(f"`{f.name}`") for f in own.fields if f.dataType == _STRING] + [F.col(BAD_RECORD)]
    broken = F.contains(F.concat_ws(" ", *texts), F.lit("\ufffd"))  # what bytes that aren't UTF-8 are read as
    return (rows.select(_file_name().alias("archivo"), broken.alias("broken"), F.col(BAD_RECORD).isNotNull().alias("bad"),
                        values)
            .groupBy("archivo").agg(F.count(F.lit(1)).alias("filas"), F.count_if("bad").alias("filas_malas"),
                                    F.count_if("broken").alias("rotas"), F.max("h").alias("h")).where("h is not null")
            .select("archivo", "filas", F.lit(None).cast("long").alias("filas_esperadas"), "filas_malas",
                    F.when(F.col("rotas") > 0, "codificacion").when(F.col("filas_malas") > 0, "registros")
                    .otherwise("ok").alias("estado"),
                    F.when(F.col("rotas") > 0, F.concat(F.col("rotas"), F.lit(" registros no son UTF-8"))).alias("error")))


def _parquet_status(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    scan = spark.read.schema(schema).option("ignoreCorruptFiles", True).parquet(*paths)
    promised = scan.groupBy(_file_name().alias("archivo")).agg(F.count(F.lit(1)).alias("filas_esperadas"))  # footers only
    decoded = F.xxhash64(*[F.col(f"`{c}`") for c in schema.names])  # so that every page is read
    read = (scan.select(_file_name().alias("archivo"), decoded.alias("h")).groupBy("archivo")
            .agg(F.count(F.lit(1)).alias("filas"), F.max("h").alias("h")).where("h is not null").drop("h"))
    filas = F.coalesce("filas", F.lit(0)).cast("long")
    return (promised.join(read, "archivo", "left")
            .select("archivo", filas.alias("filas"), "filas_esperadas", F.lit(0).cast("long").alias("filas_malas"),
                    F.when(filas == 0, "danado").when(filas < F.col("filas_esperadas"), "parcial").otherwise("ok")
                    .alias("estado"),
                    F.when(filas < F.col("filas_esperadas"), F.lit("faltan filas que el pie anuncia")).alias("error")))


def _footer_status(spark: SparkSession, paths: list[str]) -> DataFrame:
    """State of Parquet files that give no row: empty, or damaged with the reader's message."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            state, error = [], []
            for content in batch.column(1):
                try:
                    rows = pq.read_metadata(pa.BufferReader(content.as_buffer())).num_rows
                    state.append("vacio" if rows == 0 else "danado")
                    error.append(None if rows == 0 else "ninguna fila se puede leer")
                except (pa.ArrowException, OSError) as e:
                    state.append("danado")
                    error.append(str(e))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(state, pa.string()), pa.array(error, pa.string())],
                                             ["path", "estado", "error"])

    found = spark.read.format("binaryFile").load(paths)
    small = found.where(F.col("length") <= FOOTER_BYTES).select("path", "content").mapInArrow(
        run, "path string, estado string, error string")
    large = found.where(F.col("length") > FOOTER_BYTES).select("path", F.lit("danado").alias("estado"),
                                                               F.lit("ninguna fila se puede leer").alias("error"))
    none = F.lit(0).cast("long")
    return small.unionByName(large).select(
        F.substring_index("path", "/", -1).alias("archivo"), none.alias("filas"),
        F.lit(None).cast("long").alias("filas_esperadas"), none.alias("filas_malas"), "estado", "error")


def snapshot_status(spark: SparkSession, folder: str, schema: T.StructType = LISTING_SCHEMA,
                    exclude_prefixes: Sequence[str] = ("_checkpoint", "dataset_maestro")) -> DataFrame:
    """T5 for S2, one row for each file that ``read_snapshots`` looks at: archivo, formato, filas (that can be read),
    filas_esperadas (of a Parquet footer), filas_malas (CSV records that don't fit), estado and error. States: ``ok``;
    ``vacio`` (no rows, or not a byte); ``danado`` (can't be read); ``parcial`` (fewer rows than the footer says); ``cabecera`` (a CSV
    file without a known column); ``codificacion`` (records that aren't UTF-8); ``registros`` (records that don't fit).
    """
    paths = snapshot_paths(spark, folder, exclude_prefixes)
    groups, strange = csv_groups(spark, paths["csv"], schema)
    parts = [_csv_status(spark, h, own, schema) for h, own in groups.items()]
    if paths["parquet"]:
        seen = materialize(_parquet_status(spark, paths["parquet"], schema), "snapshot-status")
        have = {r[0] for r in seen.select("archivo").collect()}  # names of files, as the folder's list has them
        silent = [p for p in paths["parquet"] if p.rsplit("/", 1)[-1] not in have]
        parts += [seen, *([_footer_status(spark, silent)] if silent else [])]
    known = spark.createDataFrame(
        [(p.rsplit("/", 1)[-1], ext, p in strange) for ext, own in paths.items() for p in own],
        "archivo string, formato string, ajeno boolean")
    if not parts:
        parts = [spark.createDataFrame([], STATUS).drop("formato")]
    found = parts[0]
    for f in parts[1:]:
        found = found.unionByName(f)
    none = F.lit(0).cast("long")
    return known.join(found, "archivo", "left").select(
        "archivo", "formato", F.coalesce("filas", none).alias("filas"), "filas_esperadas",
        F.coalesce("filas_malas", none).alias("filas_malas"),
        F.coalesce("estado", F.when(F.col("ajeno"), "cabecera").otherwise("vacio")).alias("estado"),
        F.coalesce("error", F.when(F.col("ajeno"), F.lit("ninguna columna conocida"))).alias("error"))


ROWS_PER_FILE = 250_000  # of a compressed file, which one task reads


def write_csv(df: DataFrame, path: str, sep: str = ",", compressed: bool = False) -> None:
    """S7 (and S9 with ``sep='\\t'``); ``compressed`` files (gzip) hold at most ``ROWS_PER_FILE`` rows each."""
    out = df.write.mode("overwrite").options(header=True, sep=sep, escape='"', quoteAll=False)
    if compressed:
        out = out.options(compression="gzip", maxRecordsPerFile=ROWS_PER_FILE)
    out.csv(path)


def write_snapshot(df: DataFrame, root: str, captured_at: str) -> None:
    """S8 + S10: Parquet partitioned by operation, versioned by a capture-time partition."""
    (df.withColumn("captura_ts", F.lit(captured_at)).write.mode("append")
     .partitionBy("captura_ts", "operacion").parquet(root))


def write_excluded(excluded: DataFrame, path: str) -> None:
    """Rejected rows with their reason, partitioned by reason."""
    excluded.write.mode("overwrite").partitionBy("motivo_exclusion").parquet(path)


def write_excluded_counted(tagged: DataFrame, path: str) -> DataFrame:
    """S11 + S12 in one job: the rejected rows of ``tagged`` are written, and the (step, rule, n) counts of all its rows
    are observed by the job that writes them: input, kept, and each reason (those that are none of the fixed ones
    together as ``otras``, step 99)."""
    seen = Observation(f"metricas-{uuid.uuid4().hex}")
    reason = F.col("motivo_exclusion")
    counts = [F.count(F.lit(1)).alias("entrada"), F.count(F.when(reason.isNull(), 1)).alias("conservadas"),
              F.count(F.when(~reason.isin(list(K.REASONS)), 1)).alias("otras"),
              *[F.count(F.when(reason == r, 1)).alias(r) for r in K.REASONS]]
    write_excluded(tagged.observe(seen, *counts).filter(reason.isNotNull()), path)
    got = seen.get
    rows = [(0, "entrada", got["entrada"]), (100, "conservadas", got["conservadas"])]
    rows += [(i + 1, r, got[r]) for i, r in enumerate(K.REASONS) if got[r]]
    rows += [(99, "otras", got["otras"])] if got["otras"] else []
    return tagged.sparkSession.createDataFrame(rows, "paso int, regla string, n long")


def run_metrics(tagged: DataFrame) -> DataFrame:
    """S12 without a write: the same (step, rule, n) counts from one aggregation."""
    per = tagged.groupBy("motivo_exclusion").agg(F.count(F.lit(1)).alias("n"))
    order = F.create_map(*[v for i, r in enumerate(K.REASONS) for v in (F.lit(r), F.lit(i + 1))])
    rules = per.filter(F.col("motivo_exclusion").isNotNull()).select(
        F.coalesce(F.try_element_at(order, F.col("motivo_exclusion")), F.lit(99)).alias("paso"),
        F.col("motivo_exclusion").alias("regla"), "n")
    tot = per.agg(F.sum("n").alias("entrada"),
                  F.sum(F.when(F.col("motivo_exclusion").isNull(), F.col("n")).otherwise(0)).alias("conservadas"))
    summary = tot.select(F.lit(0).alias("paso"), F.lit("entrada").alias("regla"), F.col("entrada").alias("n")).unionByName(
        tot.select(F.lit(100).alias("paso"), F.lit("conservadas").alias("regla"), F.col("conservadas").alias("n")))
    return rules.unionByName(summary)


def save_bundle(spark: SparkSession, path: str, tables: dict[str, DataFrame]) -> None:
    """The model bundle as small Parquet parameter tables under one folder."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")


def load_bundle(spark: SparkSession, path: str, names: Sequence[str]) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{path}/{n}") for n in names}
