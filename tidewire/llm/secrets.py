"""Secret scans with corpus-wide ownership frequency.

Every text is scanned for candidates: the base kinds `assign`, `access` and `hex`, and further kinds that
lie outside the base spans. A candidate's value is hashed, and its hash is counted over all documents by
distinct repositories and distinct owners. A value that `EXAMPLE_OWNERS` or more owners or `EXAMPLE_REPOSITORIES` or
more repositories have is a widely copied example, also if it stays inside one owner; one in fewer that looks
random is a live-looking credential of its owner. Exact copies of a text are one repository, as a document
that is stored often says no more of its values than one that is stored once; they still count for each of
their owners. Base spans always stay; a further candidate becomes a span only if it is live-looking.

Counts are made of (hash, owner) and (hash, repository) pairs, so that a value in a third of all documents
is spread over tasks and summed up before it meets.

A null text is empty, a null owner or repository is one of its own. Rows equal in key and text get equal
results and count once. An empty table gives an empty one. Only the named columns are read.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import fresh, in_batches, sha256, texts
from tidewire.session import cut_lineage

EXAMPLE_OWNERS = 3
EXAMPLE_REPOSITORIES = 10
# Kinds in their order, base ones first, and their patterns.
KINDS = ("assign", "access", "hex", "jwt", "pem", "vendor", "opaque")
ASSIGN = re.compile(
    r"""(?a:(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
# A run is read once: it isn't entered in its middle and gives nothing back.
JWT = re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+")
PEM = re.compile(r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END [A-Z ]{0,40}PRIVATE KEY-----")
VENDORS = ("ghp_", "gho_", "ghs_", "ghu_", "ghr_", "glpat-", "xoxb-", "xoxp-", "sk_live_", "AIza")
VENDOR = re.compile(f"(?:{'|'.join(VENDORS)})[A-Za-z0-9_-]{{16,}}")
OPAQUE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{24,}")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

Span = tuple[int, int, int, str]


def entropy(value: str) -> float:
    """Bits per character."""
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def looks_random(value: str) -> bool:
    """Neither a word nor a filler: letters and digits mixed, and many different ones."""
    return (
        entropy(value) >= 2.5 and any(c.isdigit() for c in value) and any(c.isalpha() for c in value) and "example" not in value.lower()
    )


def base_spans(text: str) -> list[Span]:
    """(start, kind, end, value) of the base kinds, ordered. A secret's value of an assignment is its right side."""
    spans = []
    lowered = text.lower()
    if any(k in lowered for k in KEYWORDS):
        spans += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    # The longer quantifier finds the same spans as the whole run that is then held against its length:
    # a run's later parts are shorter than the run.
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text)]
    spans += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(spans)


def further_spans(text: str, base: list[Span]) -> list[Span]:
    """Candidates of the other kinds that touch no base span and no earlier candidate."""
    found = []
    if "eyJ" in text:
        found += [(m.start(), 3, m.end(), m[0]) for m in JWT.finditer(text)]
    if "PRIVATE KEY-----" in text:
        found += [(m.start(), 4, m.end(), m[0]) for m in PEM.finditer(text)]
    if any(v in text for v in VENDORS):
        found += [(m.start(), 5, m.end(), m[0]) for m in VENDOR.finditer(text)]
    for m in OPAQUE.finditer(text):
        value = m[0]
        if (
            sum(c.isdigit() for c in value) >= 4
            and sum(c.isupper() for c in value) >= 3
            and sum(c.islower() for c in value) >= 3
            and entropy(value) >= 3.5
        ):
            found.append((m.start(), 6, m.end(), value))
    # In order of place; what reaches into an earlier one or into a base span is left out.
    if not found:
        return []
    taken, out = bytearray(len(text)), []
    for start, _, end, _ in base:
        taken[start:end] = b"\1" * (end - start)
    for span in sorted(found, key=lambda x: (x[1], x[0])):
        start, _, end, _ = span
        if taken.find(1, start, end) < 0:
            taken[start:end] = b"\1" * (end - start)
            out.append(span)
    return sorted(out)


def written(spans: list[tuple[int, int, int]]) -> str:
    """kind:start:end, comma-joined, by start and then by kind."""
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


SPAN_TYPE = "struct<start: bigint, kind: int, stop: bigint>"
COUNT_TYPE = "struct<start: bigint, kind: int, stop: bigint, owners: bigint, repositories: bigint>"
CANDIDATE_TYPE = "struct<start: bigint, kind: int, stop: bigint, value: bigint, random: boolean>"
SCANNED = (
    "row bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, "
    f"base array<{SPAN_TYPE}>, candidates array<{CANDIDATE_TYPE}>"
)
ARROW_SPAN = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("stop", pa.int64())])
ARROW_CANDIDATE = pa.struct([*ARROW_SPAN, ("value", pa.int64()), ("random", pa.bool_())])


def row_hash(text: str) -> Column:
    """Tells rows with the same key apart."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ("source",)) -> DataFrame:
    """One row per document, without its text: base counts and spans, and all candidates with hashed values."""
    columns = list(dict.fromkeys([key, *keep]))
    row = fresh(docs, "_row")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, digests, bases, candidates = [], [], [], []
        for t in texts(batch, text):
            base = base_spans(t)
            spans = [(s, k, e) for s, k, e, _ in base]
            kinds = [k for _, k, _ in spans]
            counts.append([kinds.count(k) for k in range(3)])
            digests.append(sha256(written(spans).encode()))
            bases.append([{"start": s, "kind": k, "stop": e} for s, k, e in spans])
            candidates.append(
                [
                    {
                        "start": s, "kind": k, "stop": e,
                        "value": xxhash.xxh64_intdigest(v.encode()) - (1 << 63), "random": looks_random(v),
                    }
                    for s, k, e, v in base + further_spans(t, base)
                ]
            )
        return pa.RecordBatch.from_arrays(
            [
                *[batch.column(c) for c in columns],
                batch.column(row),
                *[pa.array([c[k] for c in counts], pa.int64()) for k in range(3)],
                pa.array(digests, pa.string()),
                pa.array(bases, pa.list_(ARROW_SPAN)),
                pa.array(candidates, pa.list_(ARROW_CANDIDATE)),
            ],
            [*columns, "row", "n_assign", "n_access", "n_hex", "base_sha256", "base", "candidates"],
        )

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns)
    rows = docs.select(*dict.fromkeys([*columns, text]), row_hash(text).alias(row))
    return in_batches(rows, work, f"{schema}, {SCANNED}")


def ownership(found: DataFrame) -> DataFrame:
    """For every `value`: its distinct repositories and owners. Takes rows of (value, owner, repository, row).

    A text (`row`) counts for one repository, the smallest that has it.
    """
    owners = found.select("value", "owner").distinct().groupBy("value").agg(F.count(F.lit(1)).alias("owners"))
    repositories = (
        found.groupBy("value", "row")
        .agg(F.min(F.struct(F.col("repository").isNull().alias("none"), "repository")).alias("repository"))
        .select("value", "repository")
        .distinct()
        .groupBy("value")
        .agg(F.count(F.lit(1)).alias("repositories"))
    )
    return owners.join(repositories, "value")


def find_secrets(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    owner: str = "source",
    repository: str | None = None,
    example_owners: int = EXAMPLE_OWNERS,
    example_repositories: int = EXAMPLE_REPOSITORIES,
) -> DataFrame:
    """One row per document: key, base counts and digest, `n_live`, `n_example`, all `spans` in order, and
    `counts`, every candidate's place with the owners and the repositories of its value.

    `repository` is the column that names where a document is kept, by default its key. `row` is a hash
    of the text, which tells rows with the same key apart.
    """
    repository = repository or key
    scanned = cut_lineage(scan(docs, key, text, (owner, repository)), "scanned")
    scanned = scanned.select(
        F.col(key).alias("key"), F.col(owner).alias("owner"), F.col(repository).alias("repository"),
        "row", "n_assign", "n_access", "n_hex", "base_sha256", "base", "candidates",
    )
    found = scanned.select("key", "row", "owner", "repository", F.explode("candidates").alias("c")).select(
        "key", "row", "owner", "repository", "c.*"
    )
    widely = (F.col("owners") >= example_owners) | (F.col("repositories") >= example_repositories)
    span = F.struct("start", "kind", "stop")
    added = (F.col("kind") > 2) & F.col("random") & ~widely
    judged = (
        found.select("key", "row", "start", "kind", "stop", "value", "random")
        .distinct()
        .join(ownership(found), "value")
        .groupBy(F.col("key").isNull().alias("no_key"), F.coalesce("key", F.lit(0)).alias("key_or_0"), "row")
        .agg(
            F.collect_list(F.when(added, span)).alias("added"),
            F.count(F.when(~widely & F.col("random"), 1)).alias("n_live"),
            F.count(F.when(widely, 1)).alias("n_example"),
            F.array_sort(F.collect_list(F.struct("start", "kind", "stop", "owners", "repositories"))).alias("counts"),
        )
    )
    joined = scanned.withColumns({"no_key": F.col("key").isNull(), "key_or_0": F.coalesce("key", F.lit(0))}).join(
        judged, ["no_key", "key_or_0", "row"], "left"
    )
    none = F.array().cast(f"array<{SPAN_TYPE}>")
    return joined.select(
        F.col("key").alias(key), "row", "n_assign", "n_access", "n_hex", "base_sha256",
        F.coalesce("n_live", F.lit(0)).alias("n_live"),
        F.coalesce("n_example", F.lit(0)).alias("n_example"),
        F.array_sort(F.concat("base", F.coalesce("added", none))).alias("spans"),
        F.coalesce("counts", F.array().cast(f"array<{COUNT_TYPE}>")).alias("counts"),
    )


def spans_text(spans: Column) -> Column:
    """The spans as kind:start:end, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string")),
        ),
        ",",
    )


def masked(text: str, spans: list[tuple[int, int]], mask: str) -> str:
    """The text with its spans replaced; spans that touch or overlap become one mask."""
    out, at, end = [], 0, -1
    for start, stop in sorted(spans):
        if start > end:
            out += [text[at:start], mask]
        at = end = max(end, stop)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, key: str = "doc_id", text: str = "text", owner: str = "source", mask: str = "[SECRET]") -> DataFrame:
    """The documents, columns as they were, with every span of their texts replaced by the mask.

    `n_chars`, if there is such a column, follows a changed text. Base spans are found again where the text
    is; only the further spans come from the corpus-wide counts, and as they are few, the texts
    need not move for them unless Spark finds them too many to broadcast.
    """
    row, spot, no_key, added = (fresh(docs, n) for n in ("_row", "_spot", "_no_key", "_added"))
    further = F.filter("spans", lambda s: s["kind"] > 2)
    hits = cut_lineage(
        find_secrets(docs, key, text, owner)
        .filter(F.size(further) > 0)
        .select(
            F.col("row").alias(row), F.coalesce(F.col(key), F.lit(0)).alias(spot), F.col(key).isNull().alias(no_key),
            further.alias(added),
        )
        .dropDuplicates([row, spot, no_key]),
        "further-spans",
    )
    joined = docs.withColumns(
        {row: row_hash(text), spot: F.coalesce(F.col(key), F.lit(0)), no_key: F.col(key).isNull()}
    ).join(hits, [row, spot, no_key], "left")

    names = docs.columns

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        old = batch.column(text).to_pylist()
        new = []
        for t, more in zip(old, batch.column(added).to_pylist(), strict=True):
            spans = [(s, e) for s, _, e, _ in base_spans(t or "")] + [(s["start"], s["stop"]) for s in more or []]
            new.append(masked(t, spans, mask) if spans else t)
        columns = {c: batch.column(c) for c in names}
        columns[text] = pa.array(new, pa.string())
        if "n_chars" in columns:
            sizes = batch.column("n_chars").to_pylist()
            columns["n_chars"] = pa.array(
                [n if a is b else len(b) for n, a, b in zip(sizes, old, new, strict=True)], batch.column("n_chars").type
            )
        return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return in_batches(joined.select(*names, added), work, docs.schema)
