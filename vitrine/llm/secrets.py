"""Secret scans by multipart credential linking (operator 8), DataFrame functions only.

Base kinds are reported wherever they stand: ``assign`` (a key word, a
separator and a value), ``access`` (an access identifier) and ``hex`` (a long
run of hexadecimal digits). Weak kinds say little alone: ``key_id`` (a named
user or client identifier), ``secret`` (a long mixed token) and ``endpoint``
(a service address). They are reported only when a complementary part stands
within ``SCOPE`` code points in the same document: parts become intervals,
which meet in an equi-join on document and place (in steps of the scope)
with the interval condition on top, as a semi-join, so no pairs are built.

Positions come from cutting the text at the matches: the lengths of the
pieces and the matches, summed up, give where each match starts.

Cases: a null text counts as empty (no spans); an empty table gives an empty
result; repeated rows give repeated rows; further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import stored, text_or_empty

# The patterns of the base kinds.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
ASSIGN_GATE = r"(?i:passw|secret|token|api_?key)"

# Patterns of the weak kinds.
KEY_ID = r"""(?i:client_?id|key_?id|user_?name|login|account)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{4,}"""
SECRET = r"(?=[A-Za-z0-9+/_-]{0,64}[0-9])(?=[A-Za-z0-9+/_-]{0,64}[A-Z])(?=[A-Za-z0-9+/_-]{0,64}[a-z])[A-Za-z0-9+/_-]{24,}=*"
ENDPOINT = r"(?:https?|ftp|jdbc:[a-z]+|postgres|mysql|mongodb|redis|amqp|s3)://[^\x20\x09-\x0D\"'<>]+"

SCOPE = 256
RUN = 64  # matches whose places are summed one after the other
KINDS = ["assign", "access", "hex", "key_id", "secret", "endpoint"]
# Weak kind -> kinds that complete it.
COMPLEMENTS = {"key_id": ["assign", "hex", "secret"], "secret": ["access", "key_id"], "endpoint": ["assign", "access", "key_id"]}

SPAN = "array<struct<start:bigint,rank:int,kind:string,end:bigint>>"


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def find(text: Column, pattern: str, kind: str, gate: Column, keep=None) -> Column:
    """Spans of the leftmost non-overlapping matches of ``pattern`` that pass ``keep``.

    The running places are summed in two levels, inside runs of ``RUN`` matches and over the runs, so
    that no step copies more than a run of spans.
    """
    between = F.split(text, pattern, -1)
    lengths = F.zip_with(between, F.regexp_extract_all(text, F.lit(pattern), 0), lambda p, m: F.struct(
        F.length(p).cast("bigint").alias("gap"), F.coalesce(F.length(m), F.lit(0)).cast("bigint").alias("size"),
        F.coalesce(m.isNotNull() & keep(m) if keep else m.isNotNull(), F.lit(False)).alias("ok")))

    def span(start: Column, end: Column) -> Column:
        return F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), F.lit(kind).alias("kind"), end.alias("end"))

    def step(state, part):
        start = state["at"] + part["gap"]
        end = start + part["size"]
        found = F.when(part["ok"], F.concat(state["found"], F.array(span(start, end)))).otherwise(state["found"])
        return F.struct(end.alias("at"), found.alias("found"))

    none, zero = F.array().cast(SPAN), F.lit(0).cast("bigint")

    def runs_of(parts):
        last = F.floor((F.size(parts) - 1) / RUN).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.aggregate(
            F.slice(parts, i * RUN + 1, F.lit(RUN)), F.struct(zero.alias("at"), none.alias("found")), step))

    def placed(runs):
        begins = F.aggregate(
            runs, F.struct(zero.alias("at"), F.array().cast("array<bigint>").alias("begins")),
            lambda state, run: F.struct((state["at"] + run["at"]).alias("at"),
                                        F.concat(state["begins"], F.array(state["at"])).alias("begins")))["begins"]
        return F.flatten(F.zip_with(runs, begins, lambda run, begin: F.transform(
            run["found"], lambda x: span(x["start"] + begin, x["end"] + begin))))

    return F.when(gate, let(let(lengths, runs_of), placed)).otherwise(none)


def base_spans(text: Column) -> Column:
    long_value = lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 8
    return F.array_sort(F.concat(
        find(text, ASSIGN, "assign", text.rlike(ASSIGN_GATE), long_value),
        find(text, ACCESS, "access", text.contains("AKIA")),
        find(text, HEX, "hex", text.rlike(HEX)),
    ))


def weak_spans(text: Column, base: Column) -> Column:
    """Weak candidates outside the base spans, in texts that hold at least one possible partner."""
    gate = (F.size(base) > 0) | text.rlike(KEY_ID)
    weak = F.concat(
        find(text, KEY_ID, "key_id", gate & text.rlike(KEY_ID)),
        find(text, SECRET, "secret", gate),
        find(text, ENDPOINT, "endpoint", gate & text.contains("://")),
    )
    return F.filter(weak, lambda w: ~F.exists(base, lambda b: (b["start"] < w["end"]) & (w["start"] < b["end"])))


def linked(parts: DataFrame, key: list[str], scope: int = SCOPE) -> DataFrame:
    """Weak spans of ``parts`` (key, span, weak) that have a complementary part in scope."""
    needs = F.create_map(*[x for k, v in COMPLEMENTS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    rows = parts.select(*key, F.col("span.start").alias("start"), F.col("span.end").alias("end"),
                        F.col("span.kind").alias("kind"), "span", "weak")
    # a part and a widened weak span that overlap have a point in common, so they share the step of it
    steps = lambda a, b: F.explode(F.sequence(F.floor(a / scope), F.floor(b / scope))).alias("place")
    left = rows.filter("weak").select(*key, "span", "start", "end", F.explode(needs[F.col("kind")]).alias("kind"),
                                      ).select("*", steps(F.col("start") - scope, F.col("end") + scope))
    right = rows.select(*key, "kind", F.col("start").alias("other_start"), F.col("end").alias("other_end"),
                        steps(F.col("start"), F.col("end"))).alias("r")
    left = left.alias("l")
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in [*key, "kind", "place"]]
    near = [F.col("l.start") < F.col("r.other_end") + scope, F.col("r.other_start") < F.col("l.end") + scope]
    met = left.join(right, [*same, *near], "left_semi").select(*key, "span").distinct()
    return met.groupBy(*key).agg(F.collect_list("span").alias("linked"))


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, digest, spans)`` of every row: all spans in the order of start and kind,
    each with start, end (code points, end exclusive) and kind. ``digest`` is the text's."""
    text = text_or_empty(text_col)
    rows = df.select(F.col(id_col).alias("id"), text.alias("text"))
    found = rows.select("id", F.xxhash64("text").alias("digest"), F.length("text").alias("size"), "text",
                        base_spans(F.col("text")).alias("base"))
    found = found.select("id", "digest", "size", "base", weak_spans(F.col("text"), F.col("base")).alias("weak"))
    found = stored(found, "secrets")
    key = ["id", "digest", "size"]
    some = found.filter(F.size("weak") > 0).distinct()
    parts = some.select(*key, F.explode("base").alias("span"), F.lit(False).alias("weak")).unionByName(
        some.select(*key, F.explode("weak").alias("span"), F.lit(True).alias("weak")))
    both = found.alias("f").join(
        linked(parts, key).alias("k"), [F.col(f"f.{c}").eqNullSafe(F.col(f"k.{c}")) for c in key], "left")
    spans = F.array_sort(F.concat("f.base", F.coalesce("k.linked", F.array().cast(SPAN))))
    return both.select(F.col("f.id").alias(id_col), F.col("f.digest").alias("digest"), spans.alias("spans"))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def counts(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Numbers of base spans, digest of the base spans and all spans as text."""
    base = F.filter("spans", lambda s: s["kind"].isin(KINDS[:3]))
    number = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return scanned.select(
        id_col, *[number(k) for k in KINDS[:3]], F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"))


def redact(text: Column, spans: Column, mask: str = "[secret]") -> Column:
    """``text`` with every span replaced by ``mask`` (overlapping spans by one)."""

    def step(state, span):
        begin = F.greatest(span["start"], state["at"])
        fresh = span["start"] >= state["at"]
        kept = F.substring(text, (state["at"] + 1).cast("int"), F.greatest(begin - state["at"], F.lit(0)).cast("int"))
        out = F.when(fresh, F.concat(state["out"], kept, F.lit(mask))).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"), out.alias("out"))

    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))
    done = F.aggregate(spans, start, step)
    rest = F.substring(text, (done["at"] + 1).cast("int"), F.length(text))
    return F.when(F.size(spans) > 0, F.concat(done["out"], rest)).otherwise(text)
