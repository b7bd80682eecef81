"""Secret scans over an incremental blob ledger.

A text is a blob, addressed by the SHA-256 of its bytes. The ledger is a folder
of runs, each a Parquet folder of (blob, rule_version, findings): what has been
scanned with which rules. ``scan`` anti-joins the texts at hand with the ledger,
scans what is unseen, adds a run, and joins findings back to every path (``keys``:
documents, or documents and their historical versions) that has the blob.

A run counts once its writer has committed it, and of several rows for one blob
and rule version one is read: a run that broke off leaves nothing, one that is
repeated or two writers at a time change nothing.

Addresses are shuffled, texts are not, except for those that pass the gate (which
hold a word or a run that every finding has): of each such unseen blob one text
goes to the task that scans it, copies are collapsed before and after. So a pair
of blob and rule version is scanned once ever.

Findings are found by column expressions: each rule wraps its matches in two
marker characters, the text is split at them, and running sums of the pieces'
lengths are the places, in characters and in bytes. (Markers that occur in the
text itself are first replaced by another control character, which no rule can
match either.) ``redact`` cuts texts by the ledger's places; no rule runs again.

Defined cases: a null text is the empty blob and has no findings; repeated
rows and copies share one ledger entry; an empty table gives an empty result;
further columns are ignored; a row without doc_id has findings like others.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadloom.llm.base import unused
from roadloom.session import scratch

RULE_VERSION = 1

# Kind, pattern (Java syntax), least length of the match, least length of its last piece.
RULES = [
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 0, 6),
    ("access", r"AKIA[A-Z0-9]+", 20, 0),
    ("hex", r"[0-9a-f]{24,}", 24, 0),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 0),
    ("hub", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 0),
    ("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 0),
    ("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
]
BASE = ["assign", "access", "hex"]
# What a text must have for any rule to match (literals and one class run).
GATE = r"(?i)password|passwd|secret|token|api_?key|akia|[0-9a-f]{24}|eyj|gh[pousr]_|xox[abprs]-|-----begin"

# Places in characters (start, end) and bytes (at, to); ends are exclusive.
FINDINGS = "array<struct<start:int,kind_no:int,kind:string,end:int,at:int,to:int>>"

_OPEN, _CLOSE, _SAFE = "\x01", "\x02", "\x03"


def _pieces(text: Column, pattern: str) -> Column:
    """A text without markers, cut before and after each match: outside, match, outside, match, ..., outside."""
    return F.split(F.regexp_replace(text, pattern, f"{_OPEN}$0{_CLOSE}"), f"[{_OPEN}{_CLOSE}]")


def _counts(piece: Column, i: Column, pattern: str, least: int, least_last: int) -> Column:
    """Whether a piece is a match that is long enough."""
    fits = (i % 2 == 1) & (F.length(piece) >= least)
    return fits & (F.length(F.regexp_extract(piece, pattern, 2)) >= least_last) if least_last else fits


def _rule_pieces(rule: int) -> Callable[[Column, Column], Column]:
    """Of a piece: its rule, place, length and whether it counts."""
    _, pattern, least, least_last = RULES[rule]
    return lambda piece, i: F.struct(F.lit(rule).alias("rule"), i.alias("i"), F.length(piece).alias("n"), F.octet_length(piece).alias("bytes"), _counts(piece, i, pattern, least, least_last).alias("ok"))


def findings(blobs: DataFrame) -> DataFrame:
    """(blob, findings) of (blob, text): all rules' spans, by start, then by the rules' order.

    A text becomes a row for each piece of each rule, and running sums of their
    lengths are the places, so the work is in proportion to the text however many
    matches it has. A null text is one row.
    """
    safe = F.translate("text", _OPEN + _CLOSE, _SAFE * 2)
    every = F.concat(*[F.transform(_pieces(safe, pattern), _rule_pieces(k)) for k, (_, pattern, _, _) in enumerate(RULES)])
    rows = blobs.select("blob", F.explode_outer(F.when(F.col("text").isNotNull(), every)).alias("x")).select("blob", "x.*")
    before = Window.partitionBy("blob", "rule").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    sums = [F.coalesce(F.sum(c).over(before), F.lit(0)).cast("int") for c in ("n", "bytes")]
    placed = rows.select("blob", "rule", "n", "bytes", "ok", sums[0].alias("start"), sums[1].alias("at"))
    kind = F.element_at(F.array(*[F.lit(k) for k, *_ in RULES]), F.col("rule") + 1)
    span = F.struct("start", F.col("rule").alias("kind_no"), kind.alias("kind"), (F.col("start") + F.col("n")).alias("end"), "at", (F.col("at") + F.col("bytes")).alias("to"))
    return placed.groupBy("blob").agg(F.array_sort(F.collect_list(F.when(F.col("ok"), span))).alias("findings"))


def scan(spark: SparkSession, docs: DataFrame, ledger: str | None = None, version: int = RULE_VERSION, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The keys, blob, findings (array, null if none): ``ledger`` is a folder that is extended; none makes a new one in the shared folder."""
    found = _known(spark, docs, ledger, version)
    return docs.select(*keys, blob_of(F.col("text")).alias("blob")).join(found, "blob", "left")


def blob_of(text: Column) -> Column:
    """A text's address; that of no bytes for null."""
    return F.unhex(F.sha2(F.coalesce(text.cast("string"), F.lit("")).cast("binary"), 256))


def runs(spark: SparkSession, ledger: str) -> list[str]:
    """The ledger's committed runs."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{ledger}/*/_SUCCESS")
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at)
    return sorted(x.getPath().getParent().toString() for x in found or [])


def recorded(spark: SparkSession, ledger: str, version: int = RULE_VERSION) -> DataFrame | None:
    """(blob, findings) of the committed runs with this rule version; a blob may stand there again."""
    committed = runs(spark, ledger)
    if not committed:
        return None
    return spark.read.schema(f"blob binary, rule_version int, findings {FINDINGS}").parquet(*committed).filter(F.col("rule_version") == version).select("blob", "findings")


def unseen(spark: SparkSession, docs: DataFrame, ledger: str, version: int = RULE_VERSION) -> DataFrame:
    """(blob, text) of the blobs that the ledger lacks, each once; text is null where no rule can match."""
    text = F.col("text").cast("string")
    new = docs.select(F.when(text.rlike(GATE), text).alias("text"), blob_of(text).alias("blob"))
    seen = recorded(spark, ledger, version)
    if seen is not None:
        new = new.join(seen.select("blob"), "blob", "left_anti")
    return new.dropDuplicates(["blob"])


def _known(spark: SparkSession, docs: DataFrame, ledger: str | None, version: int) -> DataFrame:
    """(blob, findings) of all blobs with findings, after what is unseen among ``docs`` has been scanned and recorded."""
    path = ledger or scratch(spark, "ledger")
    scanned = findings(unseen(spark, docs, path, version))
    scanned.select("blob", F.lit(version).alias("rule_version"), F.col("findings").cast(FINDINGS).alias("findings")).write.parquet(f"{path}/run={uuid.uuid4().hex}")
    return recorded(spark, path, version).filter(F.size("findings") > 0).dropDuplicates(["blob"])


def cuts(found: DataFrame) -> DataFrame:
    """(blob, cuts) of (blob, findings): findings that overlap as one, named after the first, by place in bytes."""
    rows = found.select("blob", F.explode("findings").alias("x")).select("blob", "x.*")
    by = Window.partitionBy("blob").orderBy("at", "kind_no")
    begins = F.coalesce(F.col("at") >= F.max("to").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True))
    numbered = rows.withColumn("begins", begins).withColumn("number", F.sum(F.col("begins").cast("int")).over(by.rowsBetween(Window.unboundedPreceding, 0)))
    merged = numbered.groupBy("blob", "number").agg(F.min("at").alias("at"), F.max("to").alias("to"), F.min(F.struct("at", "kind_no", "kind"))["kind"].alias("kind"))
    return merged.groupBy("blob").agg(F.array_sort(F.collect_list(F.struct("at", "to", "kind"))).alias("cuts"))


def redact(spark: SparkSession, docs: DataFrame, ledger: str | None = None, version: int = RULE_VERSION) -> DataFrame:
    """The rows with all columns; every finding in ``text`` is replaced by its kind in brackets, and ``n_chars``, if there, is counted again.

    Only texts that pass the gate are joined with the ledger's findings; the others stay where they are.
    """
    own, blob, places = (unused(docs, n) for n in ("_own", "_blob", "_places"))
    gated = F.coalesce(F.col("text").cast("string").rlike(GATE), F.lit(False))
    known = cuts(_known(spark, docs, ledger, version)).select(F.col("blob").alias(blob), F.col("cuts").alias(places))
    rows = docs.filter(gated).withColumn(own, blob_of(F.col("text"))).join(known, F.col(own) == F.col(blob), "left")
    has = F.col(places).isNotNull()
    rows = rows.withColumn("text", F.when(has, redacted(F.col("text"), F.col(places))).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        rows = rows.withColumn("n_chars", F.when(has, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return docs.filter(~gated).unionByName(rows.select(*[F.col(f"`{c}`") for c in docs.columns]))


def redacted(text: Column, places: Column) -> Column:
    """The text with each place (bytes at to to, by place, apart from each other) replaced by [kind]; in proportion to the text."""
    raw = text.cast("string").cast("binary")
    piece = lambda at, to: F.substring(raw, at + 1, to - at).cast("string")
    before = lambda i: F.coalesce(F.get(places, i - 1)["to"], F.lit(0))
    inner = F.transform(places, lambda x, i: F.concat(piece(before(i), x["at"]), F.lit("["), x["kind"], F.lit("]")))
    return F.concat(F.array_join(inner, ""), piece(F.element_at(places, -1)["to"], F.octet_length(raw)))


def listed(found: Column) -> Column:
    """kind:start:end, comma-joined in the order given; '' if none."""
    return F.array_join(F.transform(F.coalesce(found, F.array()), lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def digest(found: DataFrame) -> DataFrame:
    """The columns doc_id, n_assign, n_access, n_hex, base_sha256, spans of ``scan``'s result."""
    all_of = F.coalesce(F.col("findings"), F.array().cast(FINDINGS))
    count = lambda kind: F.size(F.filter(all_of, lambda x: x["kind"] == kind)).cast("long")
    base = F.filter(all_of, lambda x: x["kind"].isin(BASE))
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in BASE],
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
        listed(all_of).alias("spans"),
    )
