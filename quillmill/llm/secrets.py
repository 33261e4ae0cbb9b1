"""Secret scans over an incremental blob ledger.

Every version of every path is addressed by the SHA-256 of its text.  A ledger holds, for each
(blob, rule version) pair that was ever scanned, what was found.  A run scans only the pairs
that the ledger lacks, one copy of each blob, and joins findings back to all paths and
versions that hold the blob.

``run_ledger`` keeps the ledger in a folder, one part per run; a part counts once it is whole, so
a run that breaks off is done again.  The query and the pipeline stage write and read one.

Sizes: one shuffle of the distinct texts by their address; copies are merged before it and a
hot blob is one row per map task.  Findings are joined as a small table of blobs that have any.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.llm.common import scratch, table, text_or_empty

#: Raised whenever a rule changes: pairs of blob and older version are then scanned again.
RULE_VERSION = "2"
#: Kinds in the order in which spans that start together are listed.
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "pem", "jwt")

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_PEM = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]*-----END [A-Z ]*PRIVATE KEY-----")
_JWT = re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+")
_WORDS = ("password", "passwd", "secret", "token", "api")

EMPTY_SHA = hashlib.sha256(b"").hexdigest()
_SCHEMA = "blob string, rule_version string, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def find_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) in code points, end exclusive, by start, then kind as listed."""
    found = []
    low = text.lower()
    if any(w in low for w in _WORDS):
        found += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    if "-----BEGIN" in text:
        found += [(m.start(), m.end(), "pem") for m in _PEM.finditer(text)]
    if "eyJ" in text:
        found += [(m.start(), m.end(), "jwt") for m in _JWT.finditer(text)]
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2]), x[1]))


def listed(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def redacted(text: str, spans: list[tuple[int, int, str]], mark: str = "[REDACTED]") -> str:
    """The text with each run of overlapping spans replaced by ``mark``."""
    out, at = [], 0
    for start, end, _ in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for blob, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            spans = find_spans(text)
            base = [s for s in spans if s[2] in BASE_KINDS]
            n = [sum(s[2] == k for s in base) for k in BASE_KINDS]
            rows.append((blob, RULE_VERSION, *n, hashlib.sha256(listed(base).encode()).hexdigest() if base else EMPTY_SHA, listed(spans)))
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
        kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in _SCHEMA.split(", ")])


def blob_of(text: str = "text"):
    """Content address: hex SHA-256 of the text's UTF-8; a null text counts as empty."""
    return F.sha2(text_or_empty(text), 256)


def _scanned(versions: DataFrame, ledger: DataFrame | None, text: str) -> DataFrame:
    """A row for each blob in ``versions`` that ``ledger`` has not seen under RULE_VERSION."""
    blobs = versions.select(blob_of(text).alias("blob"), text_or_empty(text).alias("text"))
    if ledger is not None:
        seen = ledger.where(F.col("rule_version") == RULE_VERSION).select("blob").distinct()
        blobs = blobs.join(seen, "blob", "left_anti")
    return blobs.dropDuplicates(["blob"]).mapInArrow(_scan, _SCHEMA)


def scan_unseen(versions: DataFrame, ledger: DataFrame | None = None, text: str = "text") -> DataFrame:
    """Findings of the blobs in ``versions`` that ``ledger`` has not seen under RULE_VERSION."""
    return _scanned(versions, ledger, text).where("spans != ''")


def updated_ledger(versions: DataFrame, ledger: DataFrame | None = None, text: str = "text") -> DataFrame:
    """The ledger after a run: what it had, and a row for each blob now scanned (with or
    without findings).  Write it beside the old one; it is the ``ledger`` of the next run."""
    new = _scanned(versions, ledger, text)
    return new if ledger is None else ledger.select(new.columns).unionByName(new)


def _runs(spark: SparkSession, folder: str) -> list[int]:
    """The whole parts of the ledger in ``folder``, by the file system that Spark uses for it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    parts = [s.getPath() for s in fs.listStatus(path) if s.getPath().getName().startswith("run=")]
    return sorted(int(p.getName()[4:]) for p in parts if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


def read_ledger(spark: SparkSession, folder: str) -> DataFrame | None:
    """The ledger in ``folder``; None before its first run."""
    parts = [f"{folder}/run={n:06d}" for n in _runs(spark, folder)]
    return spark.read.schema(_SCHEMA).parquet(*parts) if parts else None


def run_ledger(versions: DataFrame, folder: str, text: str = "text") -> DataFrame:
    """The ledger in ``folder`` after it has seen all blobs of ``versions``: only pairs of blob
    and rule version that it lacks are scanned, and written as a part of their own."""
    spark = versions.sparkSession
    new = _scanned(versions, read_ledger(spark, folder), text)
    new.write.mode("overwrite").parquet(f"{folder}/run={max(_runs(spark, folder), default=0) + 1:06d}")
    return read_ledger(spark, folder)


def known_findings(ledger: DataFrame) -> DataFrame:
    """A row per blob with findings under RULE_VERSION."""
    return ledger.where((F.col("rule_version") == RULE_VERSION) & (F.col("spans") != "")).dropDuplicates(["blob"])


def _filled(df: DataFrame) -> DataFrame:
    for c in ("n_assign", "n_access", "n_hex"):
        df = df.withColumn(c, F.coalesce(c, F.lit(0).cast("long")))
    return (
        df.withColumn("rule_version", F.coalesce("rule_version", F.lit(RULE_VERSION)))
        .withColumn("base_sha256", F.coalesce("base_sha256", F.lit(EMPTY_SHA)))
        .withColumn("spans", F.coalesce("spans", F.lit("")))
    )


def _findings(versions: DataFrame, ledger: DataFrame | None, text: str = "text") -> DataFrame:
    """A row per blob with findings, scanned now or known from ``ledger``."""
    found = scan_unseen(versions, ledger, text)
    if ledger is not None:
        found = found.unionByName(known_findings(ledger).select(found.columns))
    return found


def scan_versions(versions: DataFrame, ledger: DataFrame | None = None, text: str = "text") -> DataFrame:
    """``versions`` without their text, with findings: every row (path, version, ...) of every
    blob, scanned now or known from ``ledger``.

    Null and empty texts have no spans; repeated rows stay; an empty table gives an empty
    result.  Columns of ``versions`` named as a result column are replaced.
    """
    return join_findings(versions, _findings(versions, ledger, text), text)


def join_findings(versions: DataFrame, found: DataFrame, text: str = "text") -> DataFrame:
    """``versions`` without their text, with what ``found`` has for their blobs."""
    names = [x.split()[0] for x in _SCHEMA.split(", ")]
    rows = versions.select(*(c for c in versions.columns if c not in names and c != text), blob_of(text).alias("blob"))
    return _filled(rows.join(found, "blob", "left"))


def _redact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index("text")
        texts = []
        for text, spans in zip(batch.column(at).to_pylist(), batch.column(batch.schema.get_field_index("__spans")).to_pylist(), strict=True):
            if spans:
                parts = [s.rsplit(":", 2) for s in spans.split(",")]
                text = redacted(text, [(int(a), int(z), k) for k, a, z in parts])
            texts.append(text)
        columns = [pa.array(texts, pa.string()) if i == at else c for i, c in enumerate(batch.columns)]
        keep = [i for i, name in enumerate(batch.schema.names) if name != "__spans"]
        yield pa.RecordBatch.from_arrays([columns[i] for i in keep], names=[batch.schema.names[i] for i in keep])


def redact(docs: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """``docs`` with every found secret in ``text`` replaced; all rows stay, other columns too
    (``n_chars`` follows the text where there is one)."""
    return redact_found(docs, _findings(docs, ledger))


def redact_found(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` with the spans that ``found`` has for their blobs replaced."""
    found = found.select(F.col("blob").alias("__blob"), F.col("spans").alias("__spans"))
    joined = docs.withColumn("__blob", blob_of()).join(found, "__blob", "left").select(*docs.columns, "__spans")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    out = joined.mapInArrow(_redact, schema)
    return out.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"])) if "n_chars" in docs.columns else out


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings in every document, by way of a ledger that this first run writes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ledger = run_ledger(docs, scratch(spark))
    return join_findings(docs, known_findings(ledger)).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


def stage_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents with their secrets redacted."""
    return redact_found(docs, known_findings(run_ledger(docs, scratch(spark))))
