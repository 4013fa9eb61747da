"""Secret scans with multipart credential linking.

Base spans, leftmost and non-overlapping for each kind: ``assign`` (a named
value of 8 or more characters), ``access`` (an access key identifier of 16 or
more) and ``hex`` (32 or more hexadecimal digits).

Weak candidates are too common to report alone: ``ident`` (a named account or
client), ``blob`` (40 characters of base64 with digits and both cases) and
``endpoint`` (a URL of any scheme, or a dotted host, an IPv4 address or
localhost with a port; a bare name with a port isn't told from other pairs).  A weak candidate is reported only where
complementary parts lie within ``scope`` code points of it in the same text:

=========  ==================================================
weak       needs within its scope
=========  ==================================================
ident      a secret: assign, hex or blob
blob       an identifier: access or ident
endpoint   both an identifier and a secret
=========  ==================================================

The link is an interval join: parts are keyed by row and by bucket of ``scope``
code points, and a weak span probes the buckets that its scope touches.  Spans
of one kind don't overlap and have a least length, so a bucket holds a bounded
number and the join is linear in the text, however many parts one row has.
Only built-in functions are used; the texts are never shuffled.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanwright.llm.common import cut

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: The long runs of `AKIA[A-Z0-9]+` and of `[0-9a-f]+`: both runs are maximal,
#: so asking for the length in the pattern finds the same spans.
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
IDENT = r"""(?i:client_?id|account|user_?name|login|access_?key_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.@-]{3,}"""
BLOB = r"(?<![A-Za-z0-9+/=])(?=[A-Za-z+/]{0,39}[0-9])(?=[A-Z0-9+/]{0,39}[a-z])(?=[a-z0-9+/]{0,39}[A-Z])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=])"
#: http(s) wherever it starts; other schemes from the start of their word; and
#: dotted names, addresses and localhost with a port.
_WORD, _REST = r"[A-Za-z0-9+.-]", r"""[^\x09-\x0D\x20"'<>]{3,}"""
ENDPOINT = (
    rf"https?://[A-Za-z0-9]{_REST}"
    rf"|(?<!{_WORD})(?!{_WORD}*https?://)[A-Za-z]{_WORD}*+://[A-Za-z0-9:\[_]{_REST}"
    r"|(?<![A-Za-z0-9._@/-])(?:(?:[A-Za-z0-9-]{1,63}\.){1,126}[A-Za-z]{2,63}|\d{1,3}(?:\.\d{1,3}){3}|(?i:localhost)):\d{2,5}(?![0-9])"
)
BASE = ("assign", "access", "hex")
KINDS = (*BASE, "ident", "blob", "endpoint")
SECRETS, IDENTIFIERS, WEAK = ("assign", "hex", "blob"), ("access", "ident"), ("ident", "blob", "endpoint")
SCOPE = 200
_BLOCK = 1000
#: What every match of a kind holds; texts without it aren't searched for the kind.
HELD = {"assign": (":", "="), "access": ("AKIA",), "ident": (":", "="), "endpoint": (":",)}


def _running(lengths: Column) -> Column:
    """Running sums of an array, in blocks so that long arrays stay linear."""

    def within(block: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("n"), F.array().cast("array<long>").alias("all"))
        step = lambda acc, x: F.struct((acc["n"] + x).alias("n"), F.array_append(acc["all"], acc["n"] + x).alias("all"))
        return F.aggregate(block, start, step)

    n = F.size(lengths)
    blocks = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / _BLOCK).cast("int")), lambda b: within(F.slice(lengths, b * _BLOCK + 1, F.lit(_BLOCK))))
    begin = F.struct(F.lit(0).cast("long").alias("n"), F.array().cast("array<array<long>>").alias("all"))
    joined = F.aggregate(
        blocks,
        begin,
        lambda acc, b: F.struct((acc["n"] + b["n"]).alias("n"), F.array_append(acc["all"], F.transform(b["all"], lambda x: x + acc["n"])).alias("all")),
    )
    return F.flatten(joined["all"])


def spans_of(text: Column, pattern: str, kind: str, keep=None) -> Column:
    """array<struct<start, rank, end, kind>> of the matches, in code points, ends exclusive.

    ``keep`` says which matches count, of the matched string; all matches are
    passed over all the same.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    lengths = F.zip_with(between, found, lambda b, m: (F.length(b) + F.coalesce(F.length(m), F.lit(0))).cast("long"))
    row = F.zip_with(
        found,
        F.slice(_running(lengths), F.lit(1), F.size(found)),
        lambda m, end: F.struct((end - F.length(m)).alias("start"), F.lit(KINDS.index(kind)).alias("rank"), end.alias("end"), F.when(keep(m) if keep else F.lit(True), F.lit(kind)).alias("kind")),
    )
    none = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string>>")
    spans = F.coalesce(F.when(F.size(found) > 0, F.filter(row, lambda s: s["kind"].isNotNull())), none)
    # One condition within the other, so that nothing is searched before the first one holds.
    return F.when(reduce(or_, (text.contains(h) for h in HELD[kind])), spans).otherwise(none) if kind in HELD else spans


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_spans(documents: DataFrame, key: str = "doc_id", text: str = "text", scope: int = SCOPE) -> DataFrame:
    """One row for each row of ``documents``: doc_id, n_assign, n_access, n_hex,
    base_sha256, n_linked, spans.

    ``spans`` has all reported spans as ``kind:start:end``, by start and then
    in the order of KINDS, joined by commas; ``base_sha256`` is the digest of
    the same string of the base spans alone; ``n_linked`` counts the weak
    spans that were reported.  A null text counts as empty; keys may be null
    or repeat, each row stands for itself; an empty table gives none.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    long_enough = lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 8
    frame = documents.select(F.col(f"`{key}`").alias("doc_id"), body.alias("text"))
    found = frame.select(
        "doc_id",
        F.sort_array(F.concat(spans_of(F.col("text"), ASSIGN, "assign", long_enough), spans_of(F.col("text"), ACCESS, "access"), spans_of(F.col("text"), HEX, "hex"))).alias("base"),
        F.concat(spans_of(F.col("text"), IDENT, "ident"), spans_of(F.col("text"), BLOB, "blob"), spans_of(F.col("text"), ENDPOINT, "endpoint")).alias("weak"),
    )
    rows = cut(found.withColumn("row", F.monotonically_increasing_id()))

    parts = rows.filter(F.size("weak") > 0).select("row", F.explode(F.concat("base", "weak")).alias("p")).select("row", "p.*")
    # A part is within the scope of a weak span if their gap is at most scope.
    side = parts.select("row", F.col("kind").alias("part"), F.col("start").alias("s"), F.col("end").alias("e"))
    side = side.withColumn("bucket", F.explode(F.sequence(F.floor(F.col("s") / scope), F.floor((F.col("e") - 1) / scope))))
    weak = parts.filter(F.col("kind").isin(*WEAK))
    probe = weak.withColumn("bucket", F.explode(F.sequence(F.greatest(F.floor((F.col("start") - scope - 1) / scope), F.lit(0)), F.floor((F.col("end") + scope) / scope))))
    near = probe.join(side, ["row", "bucket"]).filter("s <= end + {0} and e >= start - {0}".format(scope))
    linked = (
        near.groupBy("row", "kind", "start", "rank", "end")
        .agg(F.max(F.col("part").isin(*SECRETS)).alias("secret"), F.max(F.col("part").isin(*IDENTIFIERS)).alias("identifier"))
        .filter("(kind = 'ident' and secret) or (kind = 'blob' and identifier) or (kind = 'endpoint' and secret and identifier)")
        .groupBy("row")
        .agg(F.collect_list(F.struct("start", "rank", "end", "kind")).alias("linked"))
    )
    none = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string>>")
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return rows.select("row", "doc_id", "base").join(linked, "row", "left").select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in BASE),
        F.sha2(_written(F.col("base")), 256).alias("base_sha256"),
        F.greatest(F.size("linked"), F.lit(0)).cast("long").alias("n_linked"),
        _written(F.sort_array(F.concat("base", F.coalesce("linked", none)))).alias("spans"),
    )
