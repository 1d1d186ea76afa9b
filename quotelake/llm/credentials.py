"""Secrets in texts, and multipart credentials linked by an interval join.

Strong patterns are reported wherever they match. Weak candidates (an account name, a random-looking
token, an endpoint) are everyday text by themselves; one is reported only where the parts that
complete it lie within ``SCOPE`` code points:

    name      needs a secret
    key       needs an identifier or an endpoint
    endpoint  needs an identifier and a secret

Access keys and names are identifiers; assignments, hex strings and keys are secrets.

Parts are as far apart as the gap from one's end to the other's start; full stops at an end do not count as part.
The interval join is an equi-join on cells of ``SCOPE`` code points: every part lies in each cell it touches, and
every candidate meets the least start and greatest end of each role in its own and the two neighbouring
cells, which decides exactly and never pairs all parts of a scope. Only built-in functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.llm.common import stored, text_of

SCOPE = 200

#: The strong patterns, in the order in which their kinds are listed.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # the runs of 20 characters and more
HEX = r"[0-9a-f]{24,}"
ASSIGNED_LEAST = 6

#: Weak candidates.
NAME = r"""(?i)\b(?:access_?key_?id|client_?id|user_?name|user|login|account)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@-]{3,}"""
KEY = (
    r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_-]*[0-9])(?=[a-z0-9+/_-]*[A-Z])(?=[A-Z0-9+/_-]*[a-z])"
    r"[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_=-])"
)
ENDPOINT = r"""(?i)\b(?:https?|ftp|ssh|s3|mysql|postgres(?:ql)?|mongodb|redis|jdbc:[a-z]+)://[^\x20\x09-\x0D"'<>]+"""

KINDS = ("assign", "access", "hex", "name", "key", "endpoint")
PATTERNS = dict(zip(KINDS, (ASSIGN, ACCESS, HEX, NAME, KEY, ENDPOINT), strict=True))
STRONG = KINDS[:3]
ROLES = {"assign": "secret", "access": "id", "hex": "secret", "name": "id", "key": "secret", "endpoint": "endpoint"}


def _spans(kind: str) -> Column:
    """Spans of one kind, leftmost and not overlapping. The text between the matches and the matches
    themselves give the positions, in code points."""
    text, pattern = F.col("__text"), PATTERNS[kind]
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if kind == "assign" else whole
    least = ASSIGNED_LEAST if kind == "assign" else 1
    between = F.split(text, pattern, -1)
    lengths = F.arrays_zip(
        F.transform(F.slice(between, 1, F.size(whole)), F.char_length).alias("skip"),
        F.transform(whole, F.char_length).alias("own"),
        F.transform(value, F.char_length).alias("value"),
        F.transform(whole, lambda x: F.char_length(F.rtrim(x, F.lit(".")))).alias("reach"),
    )
    span = "struct<start:int,rank:int,end:int,kind:string,kept:boolean,reach:int>"
    empty = F.expr(f"cast(array() as array<{span}>)")
    walked = F.aggregate(
        lengths,
        F.struct(F.lit(0).alias("at"), empty.alias("spans")),
        lambda found, x: F.struct(
            (found["at"] + x["skip"] + x["own"]).alias("at"),
            F.array_append(
                found["spans"],
                F.struct(
                    (found["at"] + x["skip"]).alias("start"),
                    F.lit(KINDS.index(kind)).alias("rank"),
                    (found["at"] + x["skip"] + x["own"]).alias("end"),
                    F.lit(kind).alias("kind"),
                    (x["value"] >= least).alias("kept"),
                    (found["at"] + x["skip"] + x["reach"]).alias("reach"),
                ),
            ).alias("spans"),
        ),
    )["spans"]
    return F.when(text.rlike(pattern), F.filter(walked, lambda s: s["kept"])).otherwise(empty)


def _listed(spans: Column) -> Column:
    """kind:start:end of each span, by start and then by kind."""
    return F.array_join(
        F.transform(
            F.array_sort(spans),
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def _linked(found: DataFrame) -> DataFrame:
    """Weak candidates with their complementary parts in scope, as ``links`` per document and text."""
    texts = found.filter(F.size("weak") > 0).dropDuplicates(["doc_id", "digest"])
    part = F.explode(F.concat("strong", "weak")).alias("part")
    parts = texts.select("doc_id", "digest", part).select(
        "doc_id",
        "digest",
        "part",
        F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])[F.col("part.kind")].alias("role"),
        F.floor(F.col("part.start") / SCOPE).alias("cell"),
        F.floor(F.col("part.reach") / SCOPE).alias("last_cell"),
    )
    ends = parts.withColumn("cell", F.explode(F.sequence("cell", "last_cell"))).groupBy(
        F.col("doc_id").alias("of_id"), F.col("digest").alias("of_digest"), F.col("cell").alias("of_cell"), "role"
    ).agg(F.min("part.start").alias("first"), F.max("part.reach").alias("last"))
    weak = parts.filter(F.col("part.rank") >= len(STRONG)).select(
        "doc_id", "digest", "part", "cell", "last_cell",
        F.explode(F.sequence(F.col("cell") - 1, F.col("last_cell") + 1)).alias("beside"),
    )
    # parts that touch one cell are less than its width apart
    near = (
        F.when(F.col("beside") < F.col("cell"), F.col("part.start") - F.col("last") <= SCOPE)
        .when(F.col("beside") > F.col("last_cell"), F.col("first") - F.col("part.reach") <= SCOPE)
        .otherwise(True)
    )
    met = weak.join(
        ends,
        F.col("doc_id").eqNullSafe(F.col("of_id"))
        & (F.col("digest") == F.col("of_digest"))
        & (F.col("beside") == F.col("of_cell")),
    ).groupBy("doc_id", "digest", "part").agg(
        *[F.max(near & (F.col("role") == role)).alias(role) for role in ("id", "secret", "endpoint")]
    )
    kind = F.col("part.kind")
    complete = (
        ((kind == "name") & F.col("secret"))
        | ((kind == "key") & (F.col("id") | F.col("endpoint")))
        | ((kind == "endpoint") & F.col("id") & F.col("secret"))
    )
    return met.filter(complete).groupBy(
        F.col("doc_id").alias("link_id"), F.col("digest").alias("link_digest")
    ).agg(F.collect_list("part").alias("links"))


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, ``strong`` and ``links`` (arrays of start, rank, end, kind, kept, reach) of every row. A null text is
    empty. Repeated rows and null ids get their own text's spans; an empty table gives an empty result."""
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("__text"))
    strong = F.concat(*[_spans(k) for k in STRONG])
    weak = F.concat(*[_spans(k) for k in KINDS[len(STRONG) :]])
    found = text.select(
        "doc_id", strong.alias("strong"), weak.alias("candidates"),
        F.xxhash64("__text", F.char_length("__text")).alias("digest"),
    )
    # a weak key that overlaps a strong match, or a span within one, is no candidate of its own
    def covers(s: Column, w: Column) -> Column:
        key = (w["kind"] == "key") & (w["start"] < s["end"]) & (s["start"] < w["end"])
        return key | ((s["start"] <= w["start"]) & (w["end"] <= s["end"]))

    clear = F.filter("candidates", lambda w: ~F.exists("strong", lambda s: covers(s, w)))
    found = stored(found.select("doc_id", "digest", "strong", clear.alias("weak")), "secrets")
    links = _linked(found)
    return found.join(
        links,
        F.col("doc_id").eqNullSafe(F.col("link_id")) & (F.col("digest") == F.col("link_digest")),
        "left",
    ).select("doc_id", "strong", F.coalesce("links", F.slice("weak", 1, 0)).alias("links"))


def digest_rows(found: DataFrame) -> DataFrame:
    kinds = F.transform("strong", lambda s: s["kind"])
    others = [F.size(F.array_remove(kinds, k)) for k in STRONG]
    counts = [(F.size(kinds) - n).cast("long").alias(f"n_{k}") for k, n in zip(STRONG, others, strict=True)]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(F.encode(_listed(F.col("strong")), "utf-8"), 256).alias("base_sha256"),
        _listed(F.concat("strong", "links")).alias("spans"),
    )
