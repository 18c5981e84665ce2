"""The corpus as a stream: cleaning to JSON lines, and running statistics."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from tinta.operators.corpus_stats import MIN_TOKENS, TOP_TOKENS, clean_corpus, sentence_lengths, statistics_of, token_counts

MAX_FILES = 64


def read_stream(
    spark: SparkSession, path: str, schema: str, fmt: str = "parquet", max_files: int = MAX_FILES, **options
) -> DataFrame:
    """File source that takes a bounded number of new files per micro-batch."""
    reader = spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", max_files)
    return reader.options(**options).load(path)


def write_clean_stream(
    stream: DataFrame,
    output: str,
    checkpoint: str,
    stopwords: Iterable[str] = (),
    text: str = "text",
    min_tokens: int = MIN_TOKENS,
    max_sentences: int | None = None,
) -> None:
    """Clean what the source holds now, write it as JSON lines and stop.

    With ``max_sentences`` the stream stops passing rows on after that many, counted over restarts.
    """
    clean = clean_corpus(stream, stopwords, text, min_tokens)
    if max_sentences is not None:
        clean = clean.limit(max_sentences)
    query = (
        clean.writeStream.format("json")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


# --- statistics of a stream -------------------------------------------------------------------------

# Segments of one level that are merged into one of the next: n batches leave at most FAN * log(n) segments.
FAN = 4
SEGMENT = "level int, first bigint, last bigint, n_sentencias bigint, total_tokens bigint, longitud_minima bigint, longitud_maxima bigint"
COUNTS = "token string, count bigint"


class SegmentStore:
    """Counts of the batches of a stream as a bounded number of folders.

    Batch ``n`` writes its token counts as a segment of level 0; ``FAN`` segments of one level are merged into one of the next. Which
    segments hold, with the numbers of their sentences, stands in the manifest of the batch, which is written last: a reader uses the newest complete
    manifest and never sees a half-done merge. A batch that is repeated starts from the manifest before it and writes the same folders again, so
    it counts once. Folders that the last two manifests do not name are deleted.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._root = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        self._files = self._root.getFileSystem(spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        where = self._path(folder)
        return [s.getPath().getName() for s in self._files.listStatus(where)] if self._files.exists(where) else []

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def manifests(self) -> list[int]:
        """Batches with a complete manifest, in order."""
        held = [int(n) for n in self._names("manifests") if n.isdigit()]
        return sorted(n for n in held if self._files.exists(self._path(f"manifests/{n}/_SUCCESS")))

    def segments(self, batch: int | None = None) -> list[Row]:
        """Segments of a manifest, of the newest one if no batch is given."""
        batch = max(self.manifests(), default=None) if batch is None else batch
        if batch is None:
            return []
        rows = self.spark.read.schema(SEGMENT).json(f"{self.path}/manifests/{batch}").collect()
        return sorted(rows, key=lambda r: r["first"])

    @staticmethod
    def folder(segment: Row) -> str:
        return f"segments/{segment['level']}-{segment['first']}-{segment['last']}"

    def counts(self, segments: list[Row]) -> DataFrame:
        """``token, count`` of some segments, added up."""
        if not segments:
            return self.spark.createDataFrame([], COUNTS)
        rows = self.spark.read.schema(COUNTS).parquet(*[f"{self.path}/{self.folder(s)}" for s in segments])
        return rows.groupBy("token").agg(F.sum("count").alias("count"))

    def add(self, sentences: DataFrame, batch: int) -> None:
        """Take in the ``tokens`` of a batch."""
        before = max((n for n in self.manifests() if n < batch), default=None)
        live = self.segments(before) if before is not None else []
        sentences = sentences.persist()
        try:
            lengths = sentence_lengths(sentences).first().asDict()
            own = Row(**{"level": 0, "first": batch, "last": batch, **lengths})
            token_counts(sentences).write.mode("overwrite").parquet(f"{self.path}/{self.folder(own)}")
        finally:
            sentences.unpersist()
        live.append(own)
        while len(group := [s for s in live if s["level"] == live[-1]["level"]]) >= FAN:
            merged = self._merged(group)
            self.counts(group).write.mode("overwrite").parquet(f"{self.path}/{self.folder(merged)}")
            live = [*live[: -len(group)], merged]
        manifest = self.spark.createDataFrame(live, SEGMENT).coalesce(1)
        manifest.write.mode("overwrite").json(f"{self.path}/manifests/{batch}")
        self._clear(batch)

    @staticmethod
    def _merged(group: list[Row]) -> Row:
        def least(name: str, choose: Callable) -> int | None:
            return choose((s[name] for s in group if s[name] is not None), default=None)

        return Row(
            level=group[0]["level"] + 1, first=group[0]["first"], last=group[-1]["last"], n_sentencias=sum(s["n_sentencias"] for s in group),
            total_tokens=sum(s["total_tokens"] for s in group), longitud_minima=least("longitud_minima", min), longitud_maxima=least("longitud_maxima", max),
        )

    def _clear(self, batch: int) -> None:
        """Delete what neither this manifest nor the one before names; a repeated batch needs the one before."""
        kept = [n for n in self.manifests() if n <= batch][-2:]
        named = {self.folder(s) for n in kept for s in self.segments(n)}
        for name in self._names("manifests"):
            if name.isdigit() and int(name) not in kept and int(name) < batch:
                self._files.delete(self._path(f"manifests/{name}"), True)
        for name in self._names("segments"):
            if f"segments/{name}" not in named:
                self._files.delete(self._path(f"segments/{name}"), True)


def write_token_counts(
    stream: DataFrame, output: str, checkpoint: str, stopwords: Iterable[str] = (), text: str = "text"
) -> None:
    """Token counts and sentence lengths of all that the source holds now, kept as a bounded number of segments.

    No state grows with the vocabulary, and a batch that is repeated after a failure counts once.
    """
    store = SegmentStore(stream.sparkSession, output)
    query = (
        clean_corpus(stream, stopwords, text)
        .select("tokens")
        .writeStream.foreachBatch(store.add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_token_counts(spark: SparkSession, output: str) -> DataFrame:
    store = SegmentStore(spark, output)
    return store.counts(store.segments())


def read_statistics(spark: SparkSession, output: str, top_n: int = TOP_TOKENS) -> DataFrame:
    """The statistics row of all sentences that were streamed, as ``corpus_statistics`` gives it for a table."""
    store = SegmentStore(spark, output)
    segments = store.segments()
    lengths = spark.createDataFrame(segments, SEGMENT).agg(
        F.coalesce(F.sum("n_sentencias"), F.lit(0)).alias("n_sentencias"),
        F.coalesce(F.sum("total_tokens"), F.lit(0)).alias("total_tokens"),
        F.min("longitud_minima").alias("longitud_minima"),
        F.max("longitud_maxima").alias("longitud_maxima"),
    )
    return statistics_of(lengths, store.counts(segments), top_n)
