"""Secret scans in DataFrame functions only: three base patterns, and character Markov models for what they miss.

Two first-order models are counted from labelled strings: random strings (what the base patterns find) and ordinary
identifiers (long words of documents without such a find). A run of identifier characters, or what the base spans leave
of it in pieces of ``LONG`` or more, is added when the log-likelihood ratio of its transitions exceeds a margin per
transition. The ratios form a table of 67 x 67 numbers, whatever the
corpus.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

# The base patterns, their kinds in order, and the least length of what each must hold.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"(AKIA[A-Z0-9]+)"
HEX = r"([0-9a-f]+)"
KINDS = {"assign": (ASSIGN, 2, 6), "access": (ACCESS, 1, 20), "hex": (HEX, 1, 24)}

LONG = 20
RUN = r"([A-Za-z0-9+/_=-]{20,})"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-."
WIDTH = len(ALPHABET)
SPAN = "struct<start:int,kind:int,end:int>"
MILLI = 1000
BACKING = 50  # counts that the frequency of a character stands for in each row of transitions


def matches(text: Column, pattern: str, group: int, least: int, kind: int) -> Column:
    """Spans of the leftmost non-overlapping matches whose group has ``least`` characters or more, in order.

    A text is split at the matches; the lengths of the pieces and of the matches give the places in code points.
    """
    pieces = F.split(text, pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(pattern), 0)
    held = whole if group == 0 else F.regexp_extract_all(text, F.lit(pattern), group)
    rows = F.arrays_zip(F.slice(pieces, 1, F.size(whole)).alias("p"), whole.alias("w"), held.alias("g"))
    rows = F.transform(rows, lambda x: F.struct(
        F.length(x["p"]).alias("gap"), F.length(x["w"]).alias("size"), (F.length(x["g"]) >= least).alias("ok")))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + x["size"]
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(x["ok"], F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("out"))
    return F.aggregate(rows, start, step, lambda acc: acc["out"])


def gated(text: Column, gate: str, spans: Column) -> Column:
    """The spans where the cheap pattern occurs at all, else none."""
    return F.when(text.rlike(gate), spans).otherwise(F.array().cast(f"array<{SPAN}>"))


# A text without these has no match that is long enough.
GATES = {"assign": r"(?i)password|passwd|secret|token|api_?key", "access": r"AKIA[A-Z0-9]{16}", "hex": r"[0-9a-f]{24}"}


def base_spans(text: Column) -> dict[str, Column]:
    return {k: gated(text, GATES[k], matches(text, p, g, n, i)) for i, (k, (p, g, n)) in enumerate(KINDS.items())}


def ordered(*spans: Column) -> Column:
    return F.array_sort(F.concat(*spans))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of all spans, by start, then kind as listed, joined by commas."""
    names = F.array(*[F.lit(k) for k in (*KINDS, "markov")])
    one = F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(one, ",")


def learn(docs: DataFrame, sample: int = 8192) -> list[int]:
    """Log-likelihood ratios (in thousandths) of all transitions, row by row, from at most ``sample`` documents.

    They are those with the smallest hashes of the id; an id with several texts has the smallest. The base patterns
    label them: what they find is a random string, words of eight or more characters elsewhere are identifiers. With no
    documents all ratios are 0 and nothing is added.
    """
    picked = docs.where("doc_id is not null").select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select("doc_id", "text").where("text is not null").join(picked, "doc_id")
    rows = rows.groupBy("doc_id").agg(F.min("text").alias("text"))
    text = F.col("text")
    found = F.array_distinct(F.concat(*[
        F.when(text.rlike(GATES[k]), F.filter(F.regexp_extract_all(text, F.lit(p), g), lambda s, n=n: F.length(s) >= n))
        .otherwise(F.array().cast("array<string>")) for k, (p, g, n) in KINDS.items()]))
    words = F.regexp_extract_all(text, F.lit(r"([A-Za-z0-9+/_=-]{8,})"), 1)
    labelled = rows.select(found.alias("found"), words.alias("words"))
    labelled = labelled.select(F.explode(F.when(F.size("found") > 0, F.transform("found", lambda s: F.struct(F.lit(1).alias("y"), s.alias("s"))))
                                         .otherwise(F.transform("words", lambda s: F.struct(F.lit(0).alias("y"), s.alias("s"))))).alias("x"))
    labelled = labelled.select("x.y", "x.s").groupBy("y", "s").agg(F.count("*").alias("times"))
    chars = F.filter(F.split("s", ""), lambda c: c != "")
    pairs = F.zip_with(F.slice(chars, 1, F.size(chars) - 1), F.slice(chars, 2, F.size(chars) - 1), lambda a, b: F.concat(a, b))
    counts = labelled.select("y", F.explode(pairs).alias("pair"), "times").groupBy("y", "pair").agg(F.sum("times").alias("n")).collect()
    return ratios(counts)


def ratios(counts: list[Row]) -> list[int]:
    """Both models from their counts; a transition is backed by how often its second character occurs at all."""
    at = {c: k for k, c in enumerate(ALPHABET)}
    logs = []
    for y in (0, 1):
        table = [[0] * WIDTH for _ in range(WIDTH)]
        for r in counts:
            a, b = (at.get(c) for c in r.pair)
            if r.y == y and a is not None and b is not None:
                table[a][b] += r.n
        total = sum(map(sum, table))
        back = [(sum(row[b] for row in table) + 1) / (total + WIDTH) for b in range(WIDTH)]
        logs.append([[math.log((n + BACKING * p) / (sum(row) + BACKING)) for n, p in zip(row, back, strict=True)] for row in table])
    return [round(MILLI * (logs[1][a][b] - logs[0][a][b])) for a in range(WIDTH) for b in range(WIDTH)]


def ratio(string: Column, model: list[int]) -> Column:
    """Log-likelihood ratio of a string, in thousandths: random against ordinary."""
    table = F.split(F.lit(",".join(map(str, model))), ",").cast("array<int>")
    zero = F.struct(F.lit(0).alias("last"), F.lit(0).cast("long").alias("sum"))

    def step(acc: Column, c: Column) -> Column:
        here = F.position(c, F.lit(ALPHABET))
        value = F.get(table, (acc["last"] - 1) * WIDTH + here - 1)
        more = F.when((acc["last"] > 0) & (here > 0), value).otherwise(0).cast("long")
        return F.struct(here.alias("last"), (acc["sum"] + more).alias("sum"))

    return F.aggregate(F.filter(F.split(string, ""), lambda c: c != ""), zero, step, lambda acc: acc["sum"])


def outside(runs: Column, base: Column) -> Column:
    """What the base spans leave of the runs, in pieces of ``LONG`` characters or more."""

    def pieces(run: Column) -> Column:
        cuts = F.array_sort(F.filter(base, lambda b: (b["start"] < run["end"]) & (run["start"] < b["end"])))

        def piece(start: Column, end: Column) -> Column:
            own = F.struct(start.alias("start"), run["kind"].alias("kind"), end.alias("end"))
            return F.when(end - start >= LONG, F.array(own)).otherwise(F.array().cast(f"array<{SPAN}>"))

        def step(acc: Column, b: Column) -> Column:
            return F.struct(F.greatest(acc["at"], b["end"]).alias("at"), F.concat(acc["out"], piece(acc["at"], b["start"])).alias("out"))

        start = F.struct(run["start"].alias("at"), F.array().cast(f"array<{SPAN}>").alias("out"))
        return F.aggregate(cuts, start, step, lambda acc: F.concat(acc["out"], piece(acc["at"], run["end"])))

    return F.flatten(F.transform(runs, pieces))


def added(text: Column, base: Column, model: list[int], margin: float) -> Column:
    """Spans of long runs, or of their pieces outside the base spans, that look more random than ordinary."""
    free = outside(matches(text, RUN, 1, LONG, len(KINDS)), base)
    fits = F.filter(free, lambda s: ratio(F.substring(text, s["start"] + 1, s["end"] - s["start"]), model)
                    > (s["end"] - s["start"] - 1) * round(MILLI * margin))
    return gated(text, RUN, fits)


def find(docs: DataFrame, model: list[int] | None = None, margin: float = 0.5) -> DataFrame:
    """All rows and columns of ``docs`` with ``assign, access, hex, markov``: arrays of spans in code points.

    A null text counts as empty. Columns of these names are replaced.
    """
    model = learn(docs) if model is None else model
    text = F.coalesce(F.col("text"), F.lit(""))
    out = docs.withColumns(base_spans(text))
    return out.withColumn("markov", added(text, F.concat("assign", "access", "hex"), model, margin))


def scan(docs: DataFrame, margin: float = 0.5) -> DataFrame:
    """Per document: counts of the base kinds, the digest of their spans, and all spans."""
    found = find(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), None, margin)
    base = listed(ordered(*[F.col(k) for k in KINDS]))
    return found.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
                        F.sha2(base.cast("binary"), 256).alias("base_sha256"),
                        listed(ordered(*[F.col(k) for k in (*KINDS, "markov")])).alias("spans"))


def redact(docs: DataFrame, mark: str = "[secret]", margin: float = 0.5) -> DataFrame:
    """``docs`` with every span of its texts replaced by ``mark``, and ``n_chars`` set anew where something was."""
    # The other columns travel as one, so that their names can't clash with those of the spans.
    row = [c for c in docs.columns if c != "text"]
    packed = docs.select("text", F.struct(*[F.col(f"`{c}`") for c in row]).alias("row"))
    found = find(packed, learn(docs), margin)
    spans = ordered(*[F.col(k) for k in (*KINDS, "markov")])
    text = F.col("text")

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        new = s["start"] >= acc["at"]
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(new, F.concat(acc["out"], gap, F.lit(mark))).otherwise(acc["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    clean = F.aggregate(spans, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    some = F.size(spans) > 0
    found = found.select("row", F.when(some, clean).otherwise(text).alias("text"), some.alias("hit"))
    kept = {c: F.col("row")[c] for c in row} | {"text": F.col("text")}
    if "n_chars" in kept:
        kind = docs.schema["n_chars"].dataType
        kept["n_chars"] = F.when(F.col("hit"), F.length("text").cast(kind)).otherwise(kept["n_chars"])
    return found.select([kept[c].alias(c) for c in docs.columns])
