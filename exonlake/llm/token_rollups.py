"""Delta-maintained token rollups by source, language and tokenizer version.

Totals are sums of signed deltas: an insert adds a document's count, a delete takes it
back, and a revised count does both.  A batch is summed by key before it is stored
(so a source with a third of all rows is combined in every task) and committed once:
its deltas are written beside the store, then renamed to ``batch=<id>``, which fails if
that batch is there already.  A batch that is sent again therefore changes nothing, and
a driver or executor lost half-way leaves no partial batch.

``compact`` folds committed batches into ``base=<n>``, which holds their sums and their
ids, and appears by one rename.  Totals are those of the newest base and of the batches
that it does not name, so a driver lost at any step of it changes no total and forgets no
id; files that no total reads any more are deleted last, or by the next compact.

Defined cases: null texts count 0 tokens; null sources, languages and versions are keys
of their own; null counts are 0; a document inserted twice counts twice until deleted
twice; an empty batch is committed and adds nothing; an empty store has no totals, and
keys whose documents and tokens are all gone have none; a batch id has letters, digits,
dots, dashes and underscores, others raise an error; further columns are ignored.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

KEYS = ("source", "lang", "version")
_SCHEMA = "source string, lang string, version string, docs long, tokens long"
_BATCH, _BASE, _STAGED = "batch=", "base=", "_staged-"
#: Tokenizer versions and what each counts.
TOKENIZERS = {"words-1": r"[^\x20\x09-\x0D]+", "pieces-2": r"[\p{L}\p{N}]+|[^\p{L}\p{N}\x20\x09-\x0D]"}


def token_count(text: Column, version: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(TOKENIZERS[version])), F.lit(0)).cast("long")


def counted(docs: DataFrame, versions: tuple[str, ...] = tuple(TOKENIZERS)) -> DataFrame:
    """source, lang, version and tokens of every document under every version."""
    each = F.array(*(F.struct(F.lit(v).alias("version"), token_count(F.col("text"), v).alias("tokens")) for v in versions))
    return docs.select("source", "lang", F.explode(each).alias("_e")).select("source", "lang", "_e.version", "_e.tokens")


def signed(counts: DataFrame, sign: int) -> DataFrame:
    """Events of one kind: sign 1 inserts, -1 deletes."""
    return counts.select(*KEYS, F.lit(sign).alias("sign"), F.coalesce("tokens", F.lit(0)).cast("long").alias("tokens"))


def revised(counts: DataFrame, old: str = "old", new: str = "new") -> DataFrame:
    """Events that replace the count ``old`` of a document by ``new``."""
    both = F.array(F.struct(F.lit(-1).alias("sign"), F.col(old).alias("tokens")), F.struct(F.lit(1).alias("sign"), F.col(new).alias("tokens")))
    return counts.select(*KEYS, F.explode(both).alias("_e")).select(*KEYS, "_e.sign", F.coalesce("_e.tokens", F.lit(0)).cast("long").alias("tokens"))


class Rollup:
    """A store of committed batches at a path that all executors share."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._fs = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._at(""))

    def _at(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def _named(self, prefix: str) -> list[str]:
        names = (s.getPath().getName() for s in self._fs.listStatus(self._at("")))
        return sorted(n.removeprefix(prefix) for n in names if n.startswith(prefix))

    def _moved(self, staged: str, final: str) -> bool:
        """Rename, unless final is there; some stores would move into it instead, which is taken back."""
        if self._fs.exists(self._at(final)) or not self._fs.rename(self._at(staged), self._at(final)):
            self._dropped(staged)
            return False
        if self._fs.exists(self._at(f"{final}/{staged}")):
            self._dropped(f"{final}/{staged}")
            return False
        return True

    def _dropped(self, name: str) -> None:
        self._fs.delete(self._at(name), True)

    def _base(self) -> tuple[int, set[str]]:
        """The newest base (0: none) and the ids of its batches; a row for each batch ever committed."""
        newest = max(map(int, self._named(_BASE)), default=0)
        if not newest:
            return 0, set()
        return newest, {r["id"] for r in self.spark.read.schema("id string").parquet(f"{self.path}/{_BASE}{newest}/ids").collect()}

    def batches(self) -> list[str]:
        """Ids of all committed batches."""
        return sorted(self._base()[1] | set(self._named(_BATCH)))

    def commit(self, batch_id: str, events: DataFrame) -> bool:
        """Store the batch's sums; False, and no change, if that batch is committed already."""
        if not re.fullmatch(r"[A-Za-z0-9._-]+", batch_id):
            raise ValueError(f"not a batch id: {batch_id!r}")
        if batch_id in self.batches():
            return False
        staged = f"{_STAGED}{uuid.uuid4().hex}"
        sums = events.groupBy(*KEYS).agg(F.sum("sign").cast("long").alias("docs"), F.sum(F.col("sign") * F.col("tokens")).alias("tokens"))
        sums.write.parquet(f"{self.path}/{staged}")
        return self._moved(staged, f"{_BATCH}{batch_id}")

    def _sums(self) -> tuple[int, set[str], DataFrame]:
        """The newest base, the ids that its and the other batches have, and the sums of all."""
        base, folded = self._base()
        live = [n for n in self._named(_BATCH) if n not in folded]
        paths = [f"{self.path}/{_BATCH}{n}" for n in live] + ([f"{self.path}/{_BASE}{base}/sums"] if base else [])
        if not paths:
            return base, folded, self.spark.createDataFrame([], _SCHEMA)
        rows = self.spark.read.schema(_SCHEMA).parquet(*paths)
        return base, folded | set(live), rows.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))

    def totals(self) -> DataFrame:
        """docs and tokens by source, lang and version over all committed batches."""
        return self._sums()[2].where("docs <> 0 or tokens <> 0")

    def compact(self) -> bool:
        """Fold all batches into a new base; False if there is nothing to fold, or another compact was first."""
        base, ids, sums = self._sums()
        if not self._named(_BATCH):
            return False
        staged, new = f"{_STAGED}{uuid.uuid4().hex}", f"{_BASE}{base + 1}"
        sums.coalesce(1).write.parquet(f"{self.path}/{staged}/sums")
        self.spark.createDataFrame([(i,) for i in sorted(ids)], "id string").coalesce(1).write.parquet(f"{self.path}/{staged}/ids")
        if not self._moved(staged, new):
            return False
        for name in ids & set(self._named(_BATCH)):
            self._dropped(f"{_BATCH}{name}")
        for n in self._named(_BASE):
            if int(n) <= base:
                self._dropped(f"{_BASE}{n}")
        return True
