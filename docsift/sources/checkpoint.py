"""The checkpoint: four Parquet tables (runs, payers, rows, visited) with keyed upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsift.functions import vocab
from docsift.functions.urls import normalise_url
from docsift.operators.rows import normalise_rows

TABLES = {
    "runs": "run_id string, started_at string, finished_at string, config_json string, argv string, version long",
    "payers": "payer_name string, status string, run_id string, attempted long, found long, failed long, skipped_robots long, dupes_collapsed long, elapsed_s double, blocked boolean, block_evidence string, stats_json string, updated_at string, version long",
    "rows": "url_key string, payer_name string, run_id string, row_json string, seq long, created_at string",
    "visited": "url_key string, payer_name string, kind string, created_at string",
}
_ROW = T.StructType([T.StructField(n, T.StringType()) for n in (*vocab.COLUMNS, "local_path")])


def row_to_json(local_path: str | None = "local_path"):
    """The 22 columns and the local path as one JSON object; blanks are kept."""
    extra = [F.col(local_path)] if local_path else [F.lit("").alias("local_path")]
    return F.to_json(F.struct(*vocab.COLUMNS, *extra))


def rows_from_json(df: DataFrame, column: str = "row_json") -> DataFrame:
    """Rows of JSON objects: unknown keys dropped, missing ones defaulted, bad JSON skipped, all normalised."""
    read = df.withColumn("_r", F.from_json(column, _ROW)).where(F.col("_r").isNotNull() & F.rlike(F.col(column), F.lit(r"^\s*\{")))
    filled = [F.coalesce(F.col(f"_r.{n}"), F.lit(vocab.DEFAULTS.get(n, ""))).alias(n) for n in (*vocab.COLUMNS, "local_path")]
    return normalise_rows(read.select(*filled, *[c for c in df.columns if c not in (column, *vocab.COLUMNS)]))


def first_writer_wins(incoming: DataFrame, existing: DataFrame, key: str = "url_key", seq: str = "seq") -> DataFrame:
    """Incoming rows whose key is neither known nor taken by an earlier incoming row."""
    first = F.row_number().over(Window.partitionBy(key).orderBy(seq))
    return incoming.withColumn("_n", first).where("_n = 1").drop("_n").join(existing.select(key).distinct(), key, "left_anti")


def latest(df: DataFrame, key: str, version: str = "version") -> DataFrame:
    """The newest row of each key."""
    w = Window.partitionBy(key).orderBy(F.desc(version))
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


class Checkpoint:
    """Tables under a root folder; appends are the only writes, readers take the newest version of a key."""

    def __init__(self, spark: SparkSession, root: str, reset: bool = False):
        self.spark, self.root = spark, root.rstrip("/")
        for name, schema in TABLES.items():
            if reset or not self._exists(name):
                spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{self.root}/{name}")

    def _exists(self, name: str) -> bool:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}/_SUCCESS")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.root}/{name}")

    def _append(self, name: str, rows: DataFrame) -> None:
        rows.select([F.col(f.name).cast(f.dataType) for f in self.table(name).schema]).write.mode("append").parquet(f"{self.root}/{name}")

    def _add(self, name: str, **values) -> None:
        names = [f.name for f in self.table(name).schema]
        self._append(name, self.spark.createDataFrame([tuple(values.get(n) for n in names)], TABLES[name]))

    def _next(self, name: str) -> int:
        return (self.table(name).agg(F.max("version")).first()[0] or 0) + 1

    def start_run(self, run_id: str, started_at: str, config_json: str = "{}", argv: str = "") -> None:
        self._add("runs", run_id=run_id, started_at=started_at, config_json=config_json, argv=argv, version=self._next("runs"))

    def finish_run(self, run_id: str, finished_at: str) -> None:
        old = latest(self.table("runs").where(F.col("run_id") == run_id), "run_id").first()
        self._add("runs", **{**old.asDict(), "finished_at": finished_at, "version": self._next("runs")})

    def runs(self) -> DataFrame:
        return latest(self.table("runs"), "run_id")

    def previous_runs(self) -> int:
        return self.table("runs").select("run_id").distinct().count()

    def mark_payer(self, payer_name: str, **values) -> None:
        self._add("payers", payer_name=payer_name, version=self._next("payers"), **values)

    def payers(self) -> DataFrame:
        return latest(self.table("payers"), "payer_name")

    def payer_status(self, payer_name: str) -> str:
        row = self.payers().where(F.col("payer_name") == payer_name).select("status").first()
        return row["status"] if row else "pending"

    def payer_stats(self) -> DataFrame:
        """Counters: the typed ones over those in stats_json."""
        names = ("attempted", "found", "failed", "skipped_robots", "dupes_collapsed")
        own = F.from_json("stats_json", ", ".join(f"{n} bigint" for n in names))
        return self.payers().withColumn("_j", own).select("payer_name", "status", *[F.coalesce(F.col(n), F.col(f"_j.{n}")).alias(n) for n in names])

    def open_payers(self, payers: DataFrame) -> DataFrame:
        """Payers without a terminal status; failed and interrupted ones come again."""
        closed = self.payers().where(F.col("status").isin(*vocab.TERMINAL_STATUSES))
        return payers.join(closed.select("payer_name"), "payer_name", "left_anti")

    def save_rows(self, rows: DataFrame, run_id: str, created_at: str) -> int:
        """Append rows (22 columns, local_path, seq) with new canonical URLs; returns how many."""
        local = "local_path" if "local_path" in rows.columns else None
        incoming = rows.select(normalise_url(F.col("document_url")).alias("url_key"), "payer_name", F.lit(run_id).alias("run_id"), row_to_json(local).alias("row_json"), F.col("seq").cast("long").alias("seq"), F.lit(created_at).alias("created_at"))
        new = first_writer_wins(incoming, self.table("rows")).persist()
        n = new.count()
        self._append("rows", new)
        new.unpersist()
        return n

    def load_rows(self, payer_name: str | None = None) -> DataFrame:
        rows = self.table("rows")
        rows = rows if payer_name is None else rows.where(F.col("payer_name") == payer_name)
        return rows_from_json(rows.select("row_json", "seq")).orderBy("seq")

    def known_row_urls(self, payer_name: str | None = None) -> DataFrame:
        rows = self.table("rows")
        return (rows if payer_name is None else rows.where(F.col("payer_name") == payer_name)).select("url_key").distinct()

    def has_row(self, urls: DataFrame, url_col: str = "url") -> DataFrame:
        return urls.withColumn("url_key", normalise_url(F.col(url_col))).join(self.known_row_urls(), "url_key", "left_semi").drop("url_key")

    def row_count(self) -> int:
        return self.table("rows").count()

    def mark_visited(self, urls: DataFrame, payer_name: str, kind: str, created_at: str, url_col: str = "url") -> None:
        rows = urls.select(normalise_url(F.col(url_col)).alias("url_key"), F.lit(payer_name).alias("payer_name"), F.lit(kind).alias("kind"), F.lit(created_at).alias("created_at")).dropDuplicates(["url_key"])
        self._append("visited", rows.join(self.table("visited").select("url_key"), "url_key", "left_anti"))

    def visited_urls(self, payer_name: str) -> DataFrame:
        return self.table("visited").where(F.col("payer_name") == payer_name).select("url_key").distinct()

    def resume_banner(self) -> str:
        closed = self.payers().where(F.col("status").isin(*vocab.TERMINAL_STATUSES)).count()
        return f"resuming: {self.previous_runs()} previous run(s), {closed} payer(s) finished, {self.row_count()} row(s) kept"
