"""Delta-maintained token counts by source, language and tokenizer version.

A ledger holds one folder of signed document rows and one of signed totals for each batch.  A batch
of changes (insert, revise, delete) is compared with what the ledger knows of just its documents;
what changes becomes rows of -1 (the old count leaves its group) and +1 (the new one enters its
own), and their sums are the batch's totals.  Rows lie in ``BUCKETS`` folders by their document's
hash, and a batch reads those of its own documents' buckets only; rows without an id, which no later
batch asks for, lie in one apart.  Totals add up over batches, whatever their order of
reading, and no batch reads or rewrites another's totals.

A batch is committed when its totals are whole (Spark's ``_SUCCESS``, written last): a batch that
broke off is unseen and is written anew, and one that is committed already is left as it is, so a
batch may be sent any number of times.  Batches of one ledger are committed one after the other.

Nulls and edges: null source or language are groups of their own; a null or empty text has no tokens
but counts as a document; of several changes to one document in a batch the last (by ``seq``, then
the larger row) holds, so repeated rows count once; a revision of an unknown document inserts it, a
delete of one changes nothing; an insert without an id counts by itself and can't be changed later,
other changes without an id do nothing; a group whose documents have all left stays out of the
totals; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.llm.common import ship_by_value, stored, table
from airshed.session import scratch_path

ship_by_value(__name__)

GROUP = ["source", "lang", "tokenizer_version"]
SUMS = ["n_docs", "n_tokens", "n_bytes"]
BUCKETS = 64  # fixed for all batches of a ledger
ROWS = "doc_id long, source string, lang string, tokenizer_version string, n_docs long, n_tokens long, n_bytes long"
STORED = f"{ROWS}, bucket int"
TOTALS = "source string, lang string, tokenizer_version string, n_docs long, n_tokens long, n_bytes long"


def bucket_of(id_col: str) -> Column:
    return F.when(F.col(id_col).isNull(), -1).otherwise(F.pmod(F.xxhash64(F.col(id_col).cast("long")), F.lit(BUCKETS))).cast("int")


def vocabulary_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def version_of(path: str) -> str:
    """Name of the vocabulary file and the start of its SHA-256."""
    with open(path, "rb") as f:
        return f"{path.rsplit('/', 1)[-1]}@{hashlib.sha256(f.read()).hexdigest()[:12]}"


def counted(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
            source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """(doc_id, source, lang, tokenizer_version, n_tokens, n_bytes) of every row."""
    from public_tokenizers import PATTERN
    version = version_of(tokenizer_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken
        with open(tokenizer_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        encode = tiktoken.Encoding(version, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        for b in batches:
            n = pa.array([len(encode(t.as_py())) for t in b.column(3)], pa.int64())
            size = pa.array([t.as_buffer().size for t in b.column(3)], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns[:3], n, size], ["doc_id", "source", "lang", "n_tokens", "n_bytes"])

    return docs.select(F.col(id_col).cast("long").alias("i"), F.col(source_col).cast("string").alias("s"),
                       F.col(lang_col).cast("string").alias("l"), F.coalesce(text_col, F.lit("")).alias("t")) \
        .mapInArrow(run, "doc_id long, source string, lang string, n_tokens long, n_bytes long") \
        .withColumn("tokenizer_version", F.lit(version))


class TokenLedger:
    """Signed token counts below a folder that all executors share."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, kind: str, batch_id: str) -> str:
        return f"{self.folder}/{kind}/batch={batch_id}"

    def committed(self) -> list[str]:
        """Ids of the committed batches."""
        jvm = self.spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/totals")
        fs = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return []
        whole = lambda s: fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))
        return sorted(s.getPath().getName().removeprefix("batch=") for s in fs.listStatus(root) if whole(s))

    def _read(self, kind: str, schema: str) -> DataFrame | None:
        parts = [self._path(kind, b) for b in self.committed()]
        if not parts:
            return None
        return self.spark.read.schema(f"{schema}, batch string").option("basePath", f"{self.folder}/{kind}").parquet(*parts)

    def known(self, touched: DataFrame) -> DataFrame | None:
        """What the ledger holds of the documents of ``touched`` (doc_id, tokenizer_version), read from
        their buckets alone; None while nothing is committed."""
        log = self._read("rows", STORED)
        if log is None:
            return None
        buckets = [r.bucket for r in touched.select(bucket_of("doc_id").alias("bucket")).distinct().collect()]  # BUCKETS at most
        return log.filter(F.col("bucket").isin(buckets)).join(touched, ["doc_id", "tokenizer_version"], "left_semi") \
            .groupBy("doc_id", *GROUP).agg(*(F.sum(c).alias(c) for c in SUMS)).filter("n_docs <> 0")

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Take in a batch (op, seq, doc_id, source, lang, tokenizer_version, n_tokens, n_bytes);
        False if it was committed before."""
        if not batch_id or set(batch_id) - set("abcdefghijklmnopqrstuvwxyz0123456789-"):
            raise ValueError(f"not a batch id: {batch_id!r}")
        if batch_id in self.committed():
            return False
        # counted once: the changes are read twice below
        changes = stored(changes.select("op", "seq", "doc_id", "source", "lang", "tokenizer_version", "n_tokens", "n_bytes"), "token-changes")
        fields = F.struct("seq", "op", "source", "lang", "n_tokens", "n_bytes")
        last = changes.filter("doc_id is not null").groupBy("doc_id", "tokenizer_version").agg(F.max(fields).alias("c")) \
            .select("doc_id", "tokenizer_version", "c.op", "c.source", "c.lang", "c.n_tokens", "c.n_bytes")
        loose = changes.filter("doc_id is null and op = 'insert'").select(last.columns)
        rows = [last.filter("op <> 'delete'").unionByName(loose).withColumn("n_docs", F.lit(1))]
        now = self.known(changes.filter("doc_id is not null").select(F.col("doc_id").cast("long"), "tokenizer_version"))
        if now is not None:  # it leaves its groups
            rows.append(now.select("doc_id", *GROUP, *((-F.col(c)).alias(c) for c in SUMS)))
        names = ["doc_id", *GROUP, *SUMS]
        signed = reduce(DataFrame.unionByName, [r.select(*(F.col(c).cast("long") if c in SUMS else F.col(c) for c in names))
                                                for r in rows])
        signed.withColumn("bucket", bucket_of("doc_id")).hint("rebalance", "bucket") \
            .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(self._path("rows", batch_id))
        written = self.spark.read.schema(STORED).parquet(self._path("rows", batch_id))
        written.groupBy(*GROUP).agg(*(F.sum(c).alias(c) for c in SUMS)) \
            .write.mode("overwrite").parquet(self._path("totals", batch_id))
        return True

    def totals(self) -> DataFrame:
        """Sums over all committed batches by source, language and tokenizer version."""
        parts = self._read("totals", TOTALS)
        if parts is None:
            return self.spark.createDataFrame([], TOTALS)
        return parts.groupBy(*GROUP).agg(*(F.sum(c).alias(c) for c in SUMS)).filter("n_docs <> 0")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after three batches: all ``documents`` enter; those labelled toxic are revised (their
    counts move to the source 'review'); those labelled of low quality leave.  The first is sent twice."""
    labels = table(spark, sf_dir, "labels")
    ledger = TokenLedger(spark, scratch_path(spark, "token-ledger"))
    load = counted(table(spark, sf_dir, "documents"), vocabulary_path()).withColumns({"op": F.lit("insert"), "seq": F.lit(0)})
    ledger.commit("0001-load", load)
    ledger.commit("0001-load", load)
    known = spark.read.schema(ROWS).parquet(ledger._path("rows", "0001-load"))
    toxic = labels.filter("toxic = 1").select("doc_id").distinct()
    poor = labels.filter("quality = 0").select("doc_id").distinct()
    ledger.commit("0002-review", known.join(toxic, "doc_id", "left_semi").withColumn("source", F.lit("review"))
                  .withColumns({"op": F.lit("revise"), "seq": F.lit(0)}))
    ledger.commit("0003-drop", known.join(poor, "doc_id", "left_semi")
                  .withColumns({"op": F.lit("delete"), "seq": F.lit(0)}))
    return ledger.totals()


QUERIES = {"op1_token_counts": op1_token_counts}
ORACLE: dict[str, str] = {}
