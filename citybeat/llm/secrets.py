"""Secret scan with corpus-wide ownership frequency.

One pass over whole texts finds base credentials (three kinds, matched
leftmost and without overlap per kind) and further *candidates*: long mixed
letter/digit strings outside the base spans.  The hash of every credential
value is then counted over the corpus by distinct repositories and distinct
owners.  A value that many owners hold, or that its owners spread over many
repositories, is a copied example; a value that one or two owners hold in a few
repositories looks live.  Candidates become spans of kind ``live`` only
when they look live; base spans always stay.

The scan is written to the shared folder once; only hashes, owners and
repositories are shuffled afterwards, pre-aggregated to distinct
(hash, owner, repository) rows, so a value copied into a third of all rows
costs one row per task and owner.

Edge cases: null text is empty (no spans); null owner or repository counts as
one unnamed owner; repeated rows each give a row; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citybeat.llm.common import map_rows, materialise, numbered

# The three base kinds in listed order, patterns and least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KEYWORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
KINDS = ("assign", "access", "hex", "live")

#: Candidate strings of the method: 20 or more characters of the usual key alphabets.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
MIN_ENTROPY = 3.0
#: A value held by more owners than this is a copied example.
MAX_LIVE_OWNERS = 2
#: So is one that its owners spread over more repositories than this.
MAX_LIVE_REPOSITORIES = 16


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind index, end, value) of every base match, ordered by start, then kind."""
    found = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        found += [(m.start(), 0, m.end(), m.group(2)) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m.group()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end(), m.group()) for m in HEX.finditer(text)]
    return sorted(found)


def looks_random(value: str) -> bool:
    """Letters and digits mixed, with at least ``MIN_ENTROPY`` bits a character."""
    if not (any(c.isdigit() for c in value) and any(c.isalpha() for c in value)):
        return False
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) >= MIN_ENTROPY


def candidate_spans(text: str, taken: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int, str]]:
    """Random-looking strings that overlap no base span (``taken``, ordered by start)."""
    merged: list[list[int]] = []
    for s, _, e, _ in taken:
        if merged and s <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], e)
        else:
            merged.append([s, e])
    out, i = [], 0
    for m in CANDIDATE.finditer(text):
        while i < len(merged) and merged[i][1] <= m.start():
            i += 1
        if (i < len(merged) and merged[i][0] < m.end()) or not looks_random(m.group()):
            continue
        out.append((m.start(), 3, m.end(), m.group()))
    return out


def scan(df: DataFrame, key: str = "doc_id", text: str = "text", owner: str = "source", repository: str = "lang") -> DataFrame:
    """One row per document: base counts, base spans and every value with its hash."""

    def process(batches):
        for batch in batches:
            out: dict[str, list] = {n: [] for n in ("doc_id", "text_md5", "owner", "repository", "found")}
            for k, t, o, r in zip(batch[key], batch[text], batch[owner], batch[repository]):
                t = t or ""
                spans = base_spans(t)
                spans = sorted(spans + candidate_spans(t, spans))
                out["doc_id"].append(k)
                out["text_md5"].append(hashlib.md5(t.encode()).hexdigest())
                out["owner"].append(None if o is None else str(o))
                out["repository"].append(f"{o}/{r}")
                out["found"].append(
                    [
                        {"kind": kind, "start": s, "end": e, "value_hash": hashlib.sha256(v.encode("utf-8", "replace")).hexdigest()}
                        for s, kind, e, v in spans
                    ]
                )
            yield out

    schema = (
        "doc_id long, text_md5 string, owner string, repository string, "
        "found array<struct<kind:int,start:int,end:int,value_hash:string>>"
    )
    rows = map_rows(df, [key, text, owner, repository], process, schema)
    return rows.withColumn("row_id", F.monotonically_increasing_id())


def ownership(found: DataFrame) -> DataFrame:
    """value_hash -> number of distinct owners, repositories and holders."""
    held = (
        found.select("owner", "repository", F.explode(F.array_distinct(F.col("found.value_hash"))).alias("value_hash"))
        .groupBy("value_hash", "owner", "repository")
        .agg(F.count(F.lit(1)).alias("n_docs"))
    )
    by_owner = held.groupBy("value_hash", "owner").agg(
        F.count(F.lit(1)).alias("n_repositories"), F.sum("n_docs").alias("n_docs")
    )
    return by_owner.groupBy("value_hash").agg(
        F.count(F.lit(1)).alias("n_owners"),
        F.sum("n_repositories").alias("n_repositories"),
        F.sum("n_docs").alias("n_docs"),
    )


def find_secrets(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    owner: str = "source",
    repository: str = "lang",
    max_live_owners: int = MAX_LIVE_OWNERS,
    max_live_repositories: int = MAX_LIVE_REPOSITORIES,
) -> DataFrame:
    """Spans of every document with the verdict of the corpus.

    ``repository`` is a name inside its owner.

    Returns ``row_id, doc_id, text_md5, spans`` where ``spans`` is an array, ordered by
    start and kind, of (start, kind, end, value_hash, n_owners,
    n_repositories, live).  Candidates that do not look live are left out.
    """
    found = materialise(scan(df, key, text, owner, repository), "secrets")
    few = (F.col("n_owners") <= max_live_owners) & (F.col("n_repositories") <= max_live_repositories)
    values = ownership(found.filter(F.size("found") > 0)).withColumn("live", few)
    judged = (
        found.filter(F.size("found") > 0)
        .select("row_id", F.explode("found").alias("s"))
        .select("row_id", "s.*")
        .join(values, "value_hash")
        .filter((F.col("kind") < 3) | F.col("live"))
        .groupBy("row_id")
        .agg(
            F.sort_array(
                F.collect_list(F.struct("start", "kind", "end", "value_hash", "n_owners", "n_repositories", "live"))
            ).alias("spans")
        )
    )
    empty = "array<struct<start:int,kind:int,end:int,value_hash:string,n_owners:long,n_repositories:long,live:boolean>>"
    return (
        found.select("row_id", "doc_id", "text_md5")
        .join(judged, "row_id", "left")
        .withColumn("spans", F.coalesce("spans", F.from_json(F.lit("[]"), empty)))
    )


def span_digest(spans: F.Column) -> F.Column:
    """``kind:start:end`` of every span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def redact(df: DataFrame, spans: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Replace live spans of ``text`` by ``[SECRET]``; copied examples stay.

    ``spans`` is the result of ``find_secrets`` on ``df``.  Rows without live
    spans are untouched and keep their columns.
    """
    live = (
        spans.withColumn("live_spans", F.filter("spans", lambda s: s["live"]))
        .filter(F.size("live_spans") > 0)
        .groupBy(F.col("doc_id").alias("_k"), F.col("text_md5").alias("_md5"))
        .agg(F.first("live_spans").alias("live_spans"))
    )
    state = "struct<at:int,out:string>"
    rows, names = numbered(df)
    key, text = names[key], names[text]
    same = F.col(key).eqNullSafe(F.col("_k")) & (F.md5(F.col(text)) == F.col("_md5"))
    joined = rows.join(live, same, "left")
    cut = F.aggregate(
        "live_spans",
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")).cast(state),
        lambda a, s: F.when(
            s["start"] >= a["at"],
            F.struct(
                s["end"].alias("at"),
                F.concat(
                    a["out"], F.substring(F.col(text), a["at"] + 1, s["start"] - a["at"]), F.lit("[SECRET]")
                ).alias("out"),
            ),
        ).otherwise(F.struct(F.greatest(a["at"], s["end"]).alias("at"), a["out"].alias("out"))).cast(state),
        lambda a: F.concat(a["out"], F.substring(F.col(text), a["at"] + 1, F.lit(2147483647))),
    )
    return joined.withColumn(text, F.when(F.col("live_spans").isNotNull(), cut).otherwise(F.col(text))).select(*rows.columns).toDF(*df.columns)
