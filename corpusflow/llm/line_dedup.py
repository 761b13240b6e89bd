"""Drop lines that an earlier line repeats, exactly or but for one character; DataFrame functions only.

Near-equal lines are found by a deletion-neighbourhood join: a line stands under the hash of itself and
of every variant with one character left out; lines within one edit meet under a variant, are verified
by comparing what lies before and after the edit, and the earliest stays. Two facts keep this linear. Lines that lie one edit
apart agree in their first or their last half, so only lines that share a half with another line emit
variants, and only of the other half. And lines that differ in the character at one place stand under
the same variant *and place*, where all are within one edit of the first, so each is held against the
earliest line of its key alone: no pairs are made.

A line has as many variants as characters, each as long as the line. So that a long line does not take
time with the square of its length, the place of the edit is narrowed first, from half a line to a
sixteenth, then sixteen times further each time: a line stands under the hash of all that lies before
and after a window of it, and only windows that another line shares are cut further. Variants are
spelled out for the places of the last, short windows alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.session import stage

# Shorter lines (headings, list marks, greetings) are left alone, unless exact repeats are asked for at every length.
MIN_CHARS = 20
# Places up to which a window is not cut any further, and windows that a wider one is cut into.
SPAN, PARTS = 64, 16
# A line with a word in it.
WORDED = r"[\p{L}\p{N}]"
# Rows of a table of hashes up to which it is broadcast (24 bytes a row); a larger one is shuffled.
BROADCAST_ROWS = 1_000_000


def _small(df: DataFrame) -> DataFrame:
    """The table for a join: broadcast where its counted rows allow it."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _lines(df: DataFrame, doc: str, text: str, takes_part: Column) -> DataFrame:
    """A row for each line that takes part: its document, place, and two hashes of it."""
    rows = df.select(F.col(f"`{doc}`").alias("doc"), F.col(f"`{text}`").alias("text")).where("text is not null")
    split = rows.select("doc", F.xxhash64("text").alias("body"), F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    kept = split.where(takes_part)
    return kept.withColumns({"h": F.xxhash64("line"), "g": F.xxhash64(F.lit(1), "line")})


def _halves(line: Column) -> Column:
    """(side, length, hash) of the halves that a line one edit away shares with this one."""
    n = F.length(line)
    half = lambda side, p: F.struct(
        F.lit(side).alias("side"),
        p.alias("p"),
        F.xxhash64(F.lit(side), p, F.substring(line, F.lit(1), p) if side == 0 else F.substring(line, n - p + 1, p)).alias("key"),
    )
    long, short = F.floor(n / 2).cast("int"), F.floor((n - 1) / 2).cast("int")
    both = F.array(half(0, short), half(1, short))
    return F.when(long == short, both).otherwise(F.concat(both, F.array(half(0, long), half(1, long))))


def _candidates(lines: DataFrame) -> DataFrame:
    """Distinct lines that share a half with another: line, first place, and where it may be edited."""
    halves = lines.select("h", F.explode(_halves(F.col("line"))["key"]).alias("key"))
    shared = halves.groupBy("key").agg(F.min("h").alias("low"), F.max("h").alias("high")).where("low != high").select("key")
    shared = stage(shared, "line-halves")
    rows = lines.select("doc", "pos", "line", F.explode(_halves(F.col("line"))).alias("half")).withColumn("key", F.col("half.key"))
    met = rows.join(_small(shared), "key", "left_semi")
    n, p, front = F.length("line"), F.col("half.p"), F.col("half.side") == 0
    found = met.groupBy("line").agg(
        F.min(F.struct("doc", "pos")).alias("at"),
        F.min(F.when(front, p + 1).otherwise(F.lit(1))).alias("low"),
        F.max(F.when(front, n).otherwise(n - p)).alias("high"),
    )
    return stage(found.withColumns({"h": F.xxhash64("line"), "g": F.xxhash64(F.lit(1), "line")}), "line-candidates")


def _windows(line: Column, spans: Column, parts: int) -> Column:
    """(key, m, low, high) of the windows, each of 1 / ``parts`` of a line, that ``spans`` touch.

    Lines one edit apart share a window by the length ``m`` of the shorter one: they agree in the ``k``
    first windows, and in all that follows the next one, counted from the end.
    """
    n = F.length(line)
    wide = lambda m: F.ceil(m / parts).cast("int")
    # An insertion lies between two places, so a window that only adjoins a span is taken too.
    first = lambda s: F.greatest(F.floor((s["low"] - 2) / wide(s["m"])), F.lit(0)).cast("int")
    last = lambda s: F.floor(F.least(s["high"], s["m"] - 1) / wide(s["m"])).cast("int")
    places = F.transform(spans, lambda s: F.transform(F.sequence(first(s), last(s)), lambda k: F.struct(s["m"].alias("m"), k.alias("k"))))

    def window(x: Column) -> Column:
        before = x["k"] * wide(x["m"])
        after = F.greatest(x["m"] - before - wide(x["m"]), F.lit(0))
        key = F.xxhash64(x["m"], x["k"], F.substring(line, F.lit(1), before), F.substring(line, n - after + 1, after))
        return F.struct(key.alias("key"), x["m"].alias("m"), (before + 1).alias("low"), (n - after).alias("high"))

    return F.transform(F.array_distinct(F.flatten(places)), window)


def _narrowed(found: DataFrame) -> DataFrame:
    """``found`` with ``spans``: where a line may be edited, as (m, low, high), ``m`` the length of the shorter line of a pair."""
    n = F.length("line")
    longest = found.agg(F.max(n)).first()[0] or 0
    spans = F.array(*[F.struct(m.alias("m"), F.col("low").cast("int").alias("low"), F.col("high").cast("int").alias("high")) for m in (n, n - 1)])
    rest, done, cut, parts = found.select("h", "g", "line", "at", spans.alias("spans")), [], 2, PARTS
    while longest > cut * SPAN:
        wide = lambda s: s["m"] > cut * SPAN  # noqa: E731, B023
        done.append(rest.where(~F.exists("spans", wide)))
        rest = rest.where(F.exists("spans", wide))
        each = rest.select("h", "g", F.explode(_windows(F.col("line"), F.filter("spans", wide), parts)).alias("w")).select("h", "g", "w.*")
        shared = each.groupBy("key").agg(F.min("h").alias("a"), F.max("h").alias("b")).where("a != b").select("key")
        met = each.join(_small(stage(shared, "line-windows")), "key", "left_semi")
        met = met.groupBy("h", "g").agg(F.collect_set(F.struct("m", "low", "high")).alias("met"))
        # Of a line at the limit, one of the two lengths may be narrow already.
        narrow = F.filter("spans", lambda s: ~wide(s))  # noqa: B023
        left = rest.join(met, ["h", "g"], "left").withColumn("spans", F.when(F.col("met").isNull(), narrow).otherwise(F.concat(narrow, "met")))
        rest = stage(left.where(F.size("spans") > 0).drop("met"), "line-spans")
        cut, parts = parts, parts * PARTS
    for some in done:
        rest = rest.unionByName(some)
    return rest


def _variants(found: DataFrame) -> DataFrame:
    """(at, h, i, v): the key of each variant, left out at place ``i``."""
    cut = lambda i: F.xxhash64(F.concat(F.substring("line", F.lit(1), i - 1), F.substring("line", i + 1, F.length("line"))))
    places = F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["low"], s["high"]))))
    each = F.transform(places, lambda i: F.struct(cut(i).alias("v"), i.alias("i")))
    return found.select("at", "h", F.explode(each).alias("x")).select("at", "h", "x.i", "x.v")


def near_lines(lines: DataFrame) -> DataFrame:
    """Hashes ``h``, ``g`` of the lines that lie one edit from an earlier line."""
    found = _narrowed(_candidates(lines))
    variants = _variants(found)
    # kind: 0 same variant and place, 1 the variant of a line, 2 the line itself.
    # Both keys of a variant come from one evaluation of it: most of the work is here.
    keys = F.array(
        F.struct(F.xxhash64("v", "i").alias("key"), F.lit(0).alias("kind")), F.struct(F.col("v").alias("key"), F.lit(1).alias("kind"))
    )
    left_out = variants.select("at", "h", "i", F.explode(keys).alias("k")).select("k.key", "k.kind", "at", "h", "i")
    spelled = found.select(F.col("h").alias("key"), F.lit(2).alias("kind"), "at", "h", F.lit(0).alias("i"))
    emitted = left_out.unionByName(spelled)
    first = lambda kind: F.min(F.when(F.col("kind") == kind, F.struct("at", "h", "i")))
    groups = emitted.groupBy("key").agg(
        first(0).alias("k0"), first(1).alias("k1"), first(2).alias("k2"), F.min("h").alias("low"), F.max("h").alias("high")
    )
    groups = stage(groups.where("low != high").select("key", "k0", "k1", "k2"), "line-variants")
    met = emitted.join(_small(groups), "key")
    # A variant is held against the line itself, the line against the earliest of its variants.
    other = F.when(F.col("kind") == 0, F.col("k0")).when(F.col("kind") == 1, F.col("k2")).otherwise(F.col("k1"))
    pairs = met.select("at", "h", "kind", "i", other.alias("other")).where("other.at < at")
    place = F.when(F.col("kind") == 2, F.col("other.i")).otherwise(F.col("i"))
    pairs = pairs.groupBy("h", F.col("other.h").alias("o")).agg(F.min(F.struct("kind", place.alias("i"))).alias("edit")).select("h", "o", "edit.*")
    mine = found.select("h", "g", "line")
    theirs = found.select(F.col("h").alias("o"), F.col("line").alias("other"))
    # The place of the edit is known, so a pair is verified by comparing what lies before and after it.
    without = lambda c: F.concat(F.substring(c, F.lit(1), F.col("i") - 1), F.substring(c, F.col("i") + 1, F.length(c)))
    one = F.when(F.col("kind") == 0, without("line") == without("other"))
    one = one.when(F.col("kind") == 1, without("line") == F.col("other")).otherwise(F.col("line") == without("other"))
    verified = pairs.join(mine, "h").join(theirs, "o").where(one)
    return stage(verified.select("h", "g").distinct(), "lines-near")


def dedup_lines(df: DataFrame, doc: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, dropped: str = "dropped_lines", short_repeats: bool = False) -> DataFrame:
    """``df`` with each text less the lines that repeat an earlier one; ``dropped`` counts them.

    Lines are cut at \\n. One is dropped if an equal line stands earlier, or an earlier line lies one
    edit (a character put in, left out or changed) away; earlier is by ``doc`` (NULL first), then by
    place in the text. Lines of fewer than ``min_chars`` characters, blanks at the ends not counted,
    stay; with ``short_repeats`` those that have a letter or digit take part in the exact match, and the
    bound is one of the one-edit match alone. No row is dropped: a text that loses all its lines becomes empty, a NULL text stays NULL.
    Rows that agree in ``doc`` and text count as one; all other columns pass, whatever their names,
    except that a column named ``dropped`` is replaced. An empty table stays empty.
    """
    long = F.length(F.trim("line")) >= min_chars
    lines = _lines(df, doc, text, long | F.col("line").rlike(WORDED) if short_repeats else long)
    equal = lines.groupBy("h", "g").agg(F.min(F.struct("doc", "pos")).alias("at"), F.count(F.lit(1)).alias("n")).where("n > 1")
    equal = stage(equal.select("h", "g", "at"), "lines-equal")
    near = near_lines(lines.where(long)).withColumn("near", F.lit(True))
    judged = lines.join(_small(equal), ["h", "g"], "left").join(_small(near), ["h", "g"], "left")
    repeated = F.col("at").isNotNull() & ~F.struct("doc", "pos").eqNullSafe(F.col("at"))
    out = judged.where(repeated | F.col("near")).groupBy("doc", "body").agg(F.array_sort(F.collect_set("pos")).alias("gone"))

    rows = df.drop(dropped)
    names = {c: f"_row.{i}" for i, c in enumerate(rows.columns)}
    rows = rows.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    body, own = F.col(f"`{names[text]}`"), F.col(f"`{names[doc]}`")
    met = rows.join(out, own.eqNullSafe(F.col("doc")) & (F.xxhash64(body) == F.col("body")), "left")
    parts, gone = F.split(body, "\n", -1), F.col("gone")
    before = lambda j: F.coalesce(F.get(gone, j - 1), F.lit(-1))
    kept = F.flatten(F.transform(F.concat(gone, F.array(F.size(parts))), lambda x, j: F.slice(parts, before(j) + 2, x - before(j) - 1)))
    left = F.when(gone.isNull(), body).otherwise(F.array_join(kept, "\n"))
    count = F.coalesce(F.size(gone), F.lit(0)).cast("long")
    shown = [(left if c == text else F.col(f"`{n}`")).alias(c) for c, n in names.items()]
    return met.select(*shown, F.greatest(count, F.lit(0)).alias(dropped))
