"""Secret scans with an incremental blob ledger.

Every version of every path is addressed by the SHA-256 of its bytes.  The ledger (a Parquet folder) has one row for
each (blob, rules) that was ever scanned, with all its findings.  A scan takes a history (path, text), keeps one
path for each blob that the ledger lacks under the present rules, reads only those texts, appends their findings,
and joins the ledger back to all paths.  A blob that a third of all paths share is read once; new rules rescan
every blob once.

Base rules (fixed by contract) are matched leftmost and without overlaps each; matches that fail a length limit are
dropped.  The method adds private-key headers, web tokens and repository tokens.

Defined results: null texts count as empty; a null path keeps its findings and its row; several versions of a path give
one row each, exact repeats of a row give equal rows; an empty history gives an empty result and leaves the ledger as it is;
other columns take no part.
"""
from __future__ import annotations

import re

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velocube.llm.common import fresh_path, join_checked, written

# The base kinds in their order, then the added ones.
KINDS = ["assign", "access", "hex", "pem", "webtoken", "repotoken"]
RULES = "2"  # part of the ledger's key: raise it with any change of a rule
SPANS = "array<struct<start:long,kind:int,end:long>>"
LEDGER = f"blob binary, rules string, spans {SPANS}"
_ASSIGN = re.compile(rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([a-z0-9+/_.=-]+)")  # over lower-cased bytes
_ACCESS = re.compile(rb"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(rb"[0-9a-f]{32,}")
_MORE = [
    (3, re.compile(rb"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----")),
    (5, re.compile(rb"gh[pousr]_[A-Za-z0-9]{36,}")),
]

#: A whole run, and behind it the two other parts of a web token: each run is walked a bounded number of times.
_PARTS = re.compile(rb"(?<![A-Za-z0-9_-])([A-Za-z0-9_-]++)(?=(\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+))")


def _web_tokens(text: bytes):
    """(start, end) of eyJ and three parts of 8 signs or more each, leftmost and without overlaps."""
    end = 0
    for m in _PARTS.finditer(text) if b"eyJ" in text else ():
        at = m[1].find(b"eyJ", max(0, end - m.start()))
        if at >= 0 and len(m[1]) - at >= 11:
            end = m.end() + len(m[2])
            yield m.start() + at, end


def find(text: bytes) -> list[dict]:
    """All spans of a text in code points, by start and then kind."""
    out = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text.lower()) if m.end(2) - m.start(2) >= 8]
    out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    for kind, rule in _MORE:
        out += [(m.start(), kind, m.end()) for m in rule.finditer(text)]
    out += [(a, 4, b) for a, b in _web_tokens(text)]
    if not out:
        return []
    if not text.isascii():  # byte offsets to code points, each place decoded once
        at, chars, place = 0, 0, {}
        for p in sorted({p for s, _, e in out for p in (s, e)}):
            chars += len(text[at:p].decode())
            at, place[p] = p, chars
        out = [(place[s], kind, place[e]) for s, kind, e in out]
    return [{"start": s, "kind": kind, "end": e} for s, kind, e in sorted(out)]


def read_ledger(spark: SparkSession, path: str, rules: str = RULES) -> DataFrame:
    """The ledger's rows under these rules; a ledger that does not exist yet is empty."""
    try:
        rows = spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], LEDGER)
    return rows.where(F.col("rules") == rules).select("blob", "spans").dropDuplicates(["blob"])


def scan(history: DataFrame, ledger: str, rules: str = RULES) -> DataFrame:
    """(path, blob, spans) of every row of history (path, text); unseen blobs are scanned and put in the ledger."""
    spark = history.sparkSession
    texts = history.select("path", F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    address = F.unhex(F.sha2("text", 256))
    versions = written(texts.select("path", address.alias("blob")), "secret-versions")
    blobs = versions.groupBy("blob").agg(F.min("path").alias("path"), F.count("path").alias("named"))
    unseen = written(blobs.join(read_ledger(spark, ledger, rules).select("blob"), "blob", "left_anti"), "secret-unseen")
    reading = texts.withColumn("blob", address)
    chosen = unseen.where("named > 0").select(F.col("path").alias("_path"), F.col("blob").alias("_blob"))
    named = join_checked(reading, chosen, (F.col("path") == F.col("_path")) & (F.col("blob") == F.col("_blob")), "left_semi")
    nameless = join_checked(reading.where("path IS NULL"), unseen.where("named = 0").select(F.col("blob").alias("_blob")), F.col("blob") == F.col("_blob"), "left_semi")

    def run(batches):
        kind = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
        for batch in batches:
            spans = [find(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], names=["blob", "spans"])

    found = named.select("blob", "text").unionByName(nameless.select("blob", "text")).mapInArrow(run, f"blob binary, spans {SPANS}")
    found = found.select("blob", F.lit(rules).alias("rules"), "spans")
    if not unseen.isEmpty():
        found.write.mode("append").parquet(ledger)
    known = written(read_ledger(spark, ledger, rules), "secret-known")  # reread, so that the join may split a blob with countless paths
    return versions.join(known, "blob").select("path", "blob", "spans")


def new_ledger(spark: SparkSession) -> str:
    return fresh_path(spark, "secret-ledger")


def digest(spans):
    """kind:start:end of each span, comma-joined."""
    def one(s):
        kind = F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["kind"] + 1)
        return F.concat_ws(":", kind, s["start"].cast("string"), s["end"].cast("string"))

    return F.concat_ws(",", F.transform(spans, one))


def count(spans, kind: str):
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def clean(docs: DataFrame, ledger: str) -> DataFrame:
    """The rows of docs without those whose text holds a finding; all columns as they were."""
    found = scan(docs.select(F.col("doc_id").alias("path"), "text"), ledger)
    bad = written(found.where(F.size("spans") > 0).select(F.col("blob").alias("_blob")).distinct(), "secret-bad")
    return join_checked(docs, bad, F.unhex(F.sha2(F.coalesce(docs["text"].cast("string"), F.lit("")).cast("binary"), 256)) == bad["_blob"], "left_anti")
