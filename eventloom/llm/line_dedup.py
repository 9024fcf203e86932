"""Repeated lines, equal or within a few edits, found by an edit-distance join on segments.

With at most ``t`` edits between two lines, one of the ``t + 1`` equal segments of the shorter is found unchanged
in the longer, shifted by no more than the edits around it allow. Every distinct line is listed under its own
segments (with its length and the segment's place) and under those substrings at which a line of each length
could have them; lines that meet under a key are candidates, and a banded bit-parallel edit distance decides.

All of it is DataFrame expressions. Lines travel as hashes; their texts are written once, dealt by hash, and
only candidates are looked up there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.functions.let import let
from eventloom.llm.common import stage, stage_bucketed

MAX_EDITS = 2
# Lines of so many characters are compared within the edits.
MIN_CHARS = 30
# Shorter ones with one edit, and those shorter than this as they are: two edits make another word of a heading.
SHORT_CHARS = 15
# A document with more of its text in repeats is a copy as a whole; that is for document-level steps to judge.
MAX_REPEATED = 0.5
# With no such bound: how much of the longer of two texts lines of one earlier document must cover for a near copy.
COPIED = 0.8
_LAST = (1 << 63) - 1


def segment(length: Column, i: int, parts: int) -> tuple[Column, Column]:
    """Start (from 1) and length of the i-th of the segments of a line of this length; the last ones may be longer by one."""
    base, longer = F.floor(length / parts).cast("int"), (length % parts).cast("int")
    before = F.greatest(F.lit(0), F.lit(i - 1 - parts) + longer)
    return 1 + (i - 1) * base + before, base + (F.lit(i) > parts - longer).cast("int")


def selections(edits: int) -> list[tuple[int, int, int]]:
    """(shorter by, segment, shift): where a line looks for the segments of lines up to ``edits`` shorter.

    Edits before the segment shift it from the left end, edits behind it from the right end; both bound it.
    """
    out = []
    for less in range(edits + 1):
        for i in range(1, edits + 2):
            low, high = max(1 - i, less - (edits + 1 - i)), min(i - 1, less + (edits + 1 - i))
            out += [(less, i, shift) for shift in range(low, high + 1)]
    return out


def keys(line: Column, length: Column, edits: int) -> Column:
    """The hashes of the substrings under which a line is listed, one for each of ``selections``."""
    def listed(text: Column) -> Column:
        out = []
        for less, i, shift in selections(edits):
            start, size = segment(length - less, i, edits + 1)
            out.append(F.xxhash64(length - less, F.lit(i), F.substring(text, start + shift, size)))
        return F.array(*out)

    # The characters of a line without others than ASCII are its bytes: cut there, and hashed alike, they are found without counting.
    return F.when(F.octet_length(line) == length, listed(line.cast("binary"))).otherwise(listed(line))


def _equal_front(a: Column, b: Column) -> Column:
    """How many characters two strings have in common from the left."""
    differs = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: ~x.eqNullSafe(y))
    at = F.array_position(differs, True).cast("int")
    return F.when(at > 0, F.least(at - 1, F.length(a))).otherwise(F.length(a))


def distance(a: Column, b: Column, edits: int) -> Column:
    """The edit distance of two strings if it is at most ``edits``, else something larger.

    ``a`` is not the longer one, and ``b`` is longer by no more than ``edits``. Equal ends are set aside. Then
    one step per character of ``b`` goes over the band of ``2 * edits + 1`` cells around the diagonal, whose
    vertical differences (up: ``vp``, down: ``vn``) are the bits of two numbers; bit k of a step is the cell that
    lies k - edits below the diagonal. ``d`` follows the lowest diagonal of the band, then the last row.
    """
    def without_front(p: Column) -> Column:
        return let(_equal_front(p["a"], p["b"]), lambda n: F.struct(F.substring(p["a"], n + 1, F.length(p["a"])).alias("a"),
                                                                     F.substring(p["b"], n + 1, F.length(p["b"])).alias("b")))

    def without_back(p: Column) -> Column:
        return let(_equal_front(F.reverse(p["a"]), F.reverse(p["b"])),
                   lambda n: F.struct(F.substring(p["a"], F.lit(1), F.length(p["a"]) - n).alias("a"),
                                      F.substring(p["b"], F.lit(1), F.length(p["b"]) - n).alias("b")))

    def rest(p: Column) -> Column:
        parts = F.struct(F.split(p["a"], "").alias("a"), F.split(p["b"], "").alias("b"), F.length(p["a"]).alias("m"), F.length(p["b"]).alias("n"))
        return let(parts, lambda s: F.when(s["m"] == 0, s["n"]).otherwise(_band(s["a"], s["b"], s["m"], s["n"], edits)))

    return let(let(let(F.struct(a.alias("a"), b.alias("b")), without_front), without_back), rest)


def _band(a: Column, b: Column, m: Column, n: Column, edits: int) -> Column:
    width = 2 * edits + 1
    ones = F.lit((1 << width) - 1).cast("long")

    def long(value: int) -> Column:
        return F.lit(value).cast("long")

    def inverted(x: Column) -> Column:
        return F.bitwise_not(x).bitwiseAND(ones)

    def bit(x: Column, k: Column) -> Column:
        return F.getbit(x, k).cast("int")

    def step(state: Column, j: Column) -> Column:
        vp, vn = state["vp"], state["vn"]
        match = long(0)
        for k in range(width):
            own = j - edits + k
            match = match + F.when((own >= 1) & (F.get(a, F.greatest(own - 1, F.lit(0))) == F.get(b, j - 1)), long(1 << k)).otherwise(long(0))
        diagonal = let(match, lambda x: (x.bitwiseAND(vp) + vp).bitwiseXOR(vp).bitwiseOR(x).bitwiseOR(vn).bitwiseAND(ones))

        def across(d0: Column) -> Column:
            return F.struct(d0.alias("d0"), vn.bitwiseOR(inverted(d0.bitwiseOR(vp))).alias("hp"), d0.bitwiseAND(vp).alias("hn"))

        def down(h: Column) -> Column:
            below, row = F.shiftright(h["d0"], 1), F.greatest(m - j + edits, F.lit(0))
            d = F.when(j <= m - edits, state["d"] + 1 - bit(h["d0"], F.lit(width - 1))).otherwise(
                state["d"] + bit(h["hp"], row) - bit(h["hn"], row))
            return F.struct(h["hn"].bitwiseOR(inverted(below.bitwiseOR(h["hp"]))).alias("vp"), below.bitwiseAND(h["hp"]).alias("vn"),
                            d.cast("int").alias("d"))

        return let(let(diagonal, across), down)

    start = F.struct(long(((1 << width) - 1) & ~((1 << edits) - 1)).alias("vp"), long(0).alias("vn"),
                     F.least(m, F.lit(edits)).cast("int").alias("d"))
    return F.aggregate(F.sequence(F.lit(1), n), start, step, lambda s: s["d"])


def lines_of(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc, mark, at, line): every line that can be a repeat; a blank one cannot. Documents without an id come last."""
    return (docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc"), F.xxhash64("text").alias("mark"),
                        F.posexplode(F.split(F.col("text"), "\n")).alias("at", "line"))
            .filter((F.length("line") >= min_chars) & F.col("line").rlike("\\S")))


def parities(line: Column) -> Column:
    """128 bits: which of so many classes of character pairs occur an odd number of times.

    One edit takes away or brings at most four pairs, so lines within ``t`` edits differ in at most ``4 t`` bits.
    """
    codes = F.transform(F.split(line, ""), F.ascii)
    pairs = F.zip_with(codes, F.slice(codes, F.lit(2), F.size(codes)), lambda x, y: F.pmod(x.cast("long") * 73 + y, F.lit(128)).cast("int"))

    def half(all_: Column, k: int) -> Column:
        def flip(bits: Column, pair: Column) -> Column:
            own = F.call_function("shiftleft", F.lit(1).cast("long"), pair % 64)
            return F.when(F.floor(pair / 64) == k, bits.bitwiseXOR(own)).otherwise(bits)

        return F.aggregate(all_, F.lit(0).cast("long"), flip)

    return let(F.filter(pairs, lambda p: p.isNotNull()), lambda all_: F.struct(half(all_, 0).alias("p0"), half(all_, 1).alias("p1")))


def links(lines: DataFrame, edits: int, below: int | None = None) -> DataFrame:
    """(a, b, first_a, first_b): pairs of different lines within ``edits``, out of (id, line, first); with ``below`` only
    those whose shorter line is shorter than that.

    Lines of one key become a pair only if their lengths and parities allow it, which the join itself tests.
    """
    own = [k for k, (less, _, shift) in enumerate(selections(edits)) if less == 0 and shift == 0]
    listed = lines.select("id", F.posexplode(keys(F.col("line"), F.length("line"), edits)).alias("at", "key")).select(
        "key", "id", F.col("at").isin(own).alias("own"))
    together = Window.partitionBy("key")
    met = (listed.withColumns({"low": F.min("id").over(together), "high": F.max("id").over(together), "owned": F.max("own").over(together)})
           .filter(F.col("owned") & (F.col("low") < F.col("high"))).select("key", "id", "own"))
    met = stage(met, "met")
    signed = met.select("id").distinct().join(lines, "id").select("id", F.length("line").alias("size"), parities(F.col("line")).alias("p"))
    met = stage(met.join(signed.select("id", "size", "p.*"), "id"), "signed")
    one, two = (met.select("key", "own", *[F.col(c).alias(f"{c}_{x}") for c in ("id", "size", "p0", "p1")]) for x in "xy")
    differ = sum((F.bit_count(F.col(f"{p}_x").bitwiseXOR(F.col(f"{p}_y"))) for p in ("p0", "p1")), F.lit(0))
    near = (F.col("id_x") != F.col("id_y")) & (F.abs(F.col("size_x") - F.col("size_y")) <= edits) & (differ <= 4 * edits)
    if below is not None:
        near = near & (F.least("size_x", "size_y") < below)
    one = one.filter("own")
    pairs = one.join(two, (one["key"] == two["key"]) & near).select(
        F.least("id_x", "id_y").alias("a"), F.greatest("id_x", "id_y").alias("b")).distinct()
    first, second = (lines.select(F.col("id").alias(x), F.col("line").alias(f"line_{x}"), F.col("first").alias(f"first_{x}")) for x in "ab")
    shorter = F.length("line_a") <= F.length("line_b")
    apart = distance(F.when(shorter, F.col("line_a")).otherwise(F.col("line_b")), F.when(shorter, F.col("line_b")).otherwise(F.col("line_a")), edits)
    return pairs.join(first, "a").join(second, "b").filter(apart <= edits).select("a", "b", "first_a", "first_b")


def line_links(known: DataFrame, edits: int, min_chars: int) -> DataFrame:
    """(id, other, first): both directions of the links of lines, with the first place of the other.

    The shorter line of a pair says how many edits may lie between them.
    """
    size = F.length("line")
    found = stage(links(known.filter(size >= MIN_CHARS), edits), "links")
    if min_chars < MIN_CHARS:
        short = known.filter(size.between(SHORT_CHARS, MIN_CHARS))
        found = found.union(stage(links(short, min(1, edits), MIN_CHARS), "short_links"))
    return found.select(F.col("a").alias("id"), F.col("b").alias("other"), F.col("first_b").alias("first")).union(
        found.select(F.col("b").alias("id"), F.col("a").alias("other"), F.col("first_a").alias("first")))


def _places(docs: DataFrame, edits: int, min_chars: int) -> tuple[DataFrame, DataFrame]:
    """Every line that has an equal or near one, (doc, mark, at, chars, id, earliest, degree), and the links of lines."""
    own = lines_of(docs, min_chars).withColumn("id", F.xxhash64("line"))
    known = stage_bucketed(own.groupBy("id").agg(F.min(F.struct("doc", "at")).alias("first"), F.count("*").alias("n"),
                                                 F.min("line").alias("line")), "lines", "id")
    both = line_links(known, edits, min_chars)
    linked = both.groupBy("id").agg(F.min("first").alias("earliest"), F.count("*").alias("degree"))
    said = (known.select("id", "n", "first").join(linked, "id", "left").filter("n > 1 or degree is not null")
            .select("id", F.least("first", F.coalesce("earliest", "first")).alias("earliest"), F.coalesce("degree", F.lit(0)).alias("degree")))
    # Read back without its buckets: a line that very many documents hold can then be split by the adaptive join.
    said = stage(said, "said")
    return own.select("doc", "mark", "at", "id", F.length("line").alias("chars")).join(said, "id"), both


def _by_document(places: DataFrame) -> DataFrame:
    """(doc, mark, repeats, n_links, covered): ``covered`` is the characters of lines that another, earlier document has."""
    repeated = F.col("earliest") < F.struct("doc", "at")
    elsewhere = F.when(F.col("earliest.doc") < F.col("doc"), F.col("chars")).otherwise(0)
    # Repeated rows of one id and text raise the sum, which only chooses the documents that are looked at.
    return (places.groupBy("doc", "mark")
            .agg(F.array_sort(F.collect_set(F.when(repeated, F.col("at")))).alias("repeats"), F.sum("degree").alias("n_links"),
                 F.sum(elsewhere).alias("covered")))


def repeated_lines(docs: DataFrame, edits: int = MAX_EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per document (doc, mark): ``repeats`` (numbers of the lines, from 0, that equal or come within ``edits``
    (fewer for short lines) of a line earlier in the order of doc_id and line) and ``n_links`` (other lines within ``edits``, over all its lines).

    Only documents with a repeat or a link have a row. A null doc_id comes after all others.
    """
    return _by_document(_places(docs, edits, min_chars)[0]).drop("covered")


def _covering(pairs: DataFrame, lines: DataFrame, near: DataFrame) -> DataFrame:
    """(mark): the texts of the pairs (mark, other) of which lines of the other cover ``COPIED`` of the longer."""
    wanted = pairs.join(lines.select("mark", "id", "n", "chars", "size"), "mark").join(near, "id")
    there = lines.select(F.col("mark").alias("other"), F.col("id").alias("near"), F.col("n").alias("there"), F.col("size").alias("other_size"))
    met = wanted.join(there, ["other", "near"]).groupBy("mark", "other", "id").agg(
        F.first("n").alias("n"), F.first("chars").alias("chars"), F.first("size").alias("size"), F.first("other_size").alias("other_size"),
        F.sum("there").alias("there"))
    # A line counts as often as both have it: one that repeats its own lines is no copy of a text that has them once.
    return (met.groupBy("mark", "other").agg(F.sum(F.col("chars") * F.least("n", "there")).alias("shared"), F.first("size").alias("size"),
                                             F.first("other_size").alias("other_size"))
            .filter(F.col("shared") >= COPIED * F.greatest("size", "other_size")).select("mark").distinct())


def near_copies(docs: DataFrame, places: DataFrame, found: DataFrame, both: DataFrame) -> DataFrame:
    """(doc, mark) of the documents that are near copies of one earlier document.

    Equal texts are told by their mark. Of different ones, a text is first compared with the document that has
    most of its lines first, so large groups of copies give one pair each. For those left of which all earlier
    documents together cover enough, every earlier text that could do so alone shares one of their rarest lines,
    taken until what is left over is less than what must be shared.
    """
    size = F.length(F.replace("text", F.lit("\n"), F.lit(""))).cast("long")
    sizes = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc"), F.xxhash64("text").alias("mark"), size.alias("size"))
    firsts = stage(sizes.groupBy("mark").agg(F.min("doc").alias("first"), F.first("size").alias("size")), "firsts")
    found = found.select("doc", "mark", "covered").join(firsts, "mark")
    equal = found.filter("doc > first").select("doc", "mark")
    able = stage(found.filter("doc = first").filter(F.col("covered") >= COPIED * F.col("size")), "able")

    lines = stage(places.join(firsts, "mark").filter("doc = first").groupBy("mark", "id")
                  .agg(F.size(F.collect_set("at")).alias("n"), F.first("doc").alias("doc"), F.first("chars").alias("chars"),
                       F.first("size").alias("size"), F.first("earliest.doc").alias("earliest")), "text_lines")
    own = lines.join(able.select("mark"), "mark", "left_semi")
    alike = stage(both.select("id", F.col("other").alias("near")).distinct().union(own.select("id", F.col("id").alias("near")).distinct()), "alike")
    texts = firsts.select(F.col("mark").alias("other"), F.col("first").alias("before"), F.col("size").alias("other_size"))

    most = (own.filter("earliest < doc").groupBy("mark", "earliest").agg(F.sum(F.col("chars") * F.col("n")).alias("shared"))
            .groupBy("mark").agg(F.max(F.struct("shared", "earliest")).alias("best")).select("mark", F.col("best.earliest").alias("before")))
    nearest = stage(most.join(texts, "before").select("mark", "other"), "nearest")
    copies = stage(_covering(nearest, lines, alike), "copies")

    left = own.join(copies, "mark", "left_anti")
    held = lines.groupBy("id").agg(F.count("*").alias("in_texts"))
    common = alike.join(held.withColumnRenamed("id", "near"), "near").groupBy("id").agg(F.sum("in_texts").alias("in_texts"))
    whole = F.col("chars") * F.col("n")
    rarest = Window.partitionBy("mark").orderBy("in_texts", "id")
    before = F.col("size") - F.sum(whole).over(Window.partitionBy("mark")) + F.sum(whole).over(rarest) - whole
    chosen = (left.join(common, "id").withColumn("passed", before).filter(F.col("passed") <= (1 - COPIED) * F.col("size") + 1e-6)
              .join(alike, "id").select("mark", "doc", "size", "near"))
    others = lines.select(F.col("mark").alias("other"), F.col("doc").alias("other_doc"), F.col("size").alias("other_size"), F.col("id").alias("near"))
    may = (F.col("other_doc") < F.col("doc")) & (F.col("size") >= COPIED * F.col("other_size"))
    pairs = stage(chosen.join(others, "near").filter(may).select("mark", "other").distinct().join(nearest, ["mark", "other"], "left_anti"), "doc_pairs")
    copies = copies.union(_covering(pairs, lines, alike))
    return equal.union(able.join(copies, "mark", "left_semi").select("doc", "mark")).distinct()


def dedup_lines(docs: DataFrame, edits: int = MAX_EDITS, min_chars: int = MIN_CHARS, max_repeated: float | None = MAX_REPEATED,
                min_dropped: int = 1) -> DataFrame:
    """Each row of ``docs`` with n_lines, n_repeats, n_links, dropped (line numbers) and ``kept_text``.

    A line of at least ``min_chars`` characters that is not blank is a repeat if an equal line, or one within ``edits``
    single-character edits, comes earlier by doc_id and line number. Where the shorter of two lines has less than
    ``MIN_CHARS`` characters there may be one edit, with less than ``SHORT_CHARS`` none. Repeats below ``min_dropped``
    characters are counted but stay. Other repeats are dropped, unless they make up more than
    ``max_repeated`` of the document's characters: then it is a copy as a whole and stays as it is. Without a
    ``max_repeated`` (None) they are dropped whatever their share, except from a near copy of one earlier
    document: its lines cover ``COPIED`` of the longer of the two texts, each line counted as often as both have
    it. Rows with one id and one text count as one document; a null id comes last; null and empty texts have no
    repeats (a null text stays null). Columns named like the new ones are replaced. Texts and lines of any length
    are compared whole; an empty table gives no rows.
    """
    names = ["n_lines", "n_repeats", "n_links", "dropped", "kept_text"]
    keep = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in names]
    texts = docs.select("doc_id", "text")
    if max_repeated is None:
        places, both = _places(texts, edits, min_chars)
        places = stage(places, "places")
        found = stage(_by_document(places), "by_document")
        copies = near_copies(texts, places, found, both).withColumn("copy", F.lit(True))
        found = found.join(copies, ["doc", "mark"], "left")
    else:
        found = repeated_lines(texts, edits, min_chars)
    found = found.withColumnsRenamed({"doc": "__doc", "mark": "__mark", "copy": "__copy", "covered": "__covered"})
    keyed = docs.select(*keep, F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("__doc"), F.xxhash64("text").alias("__mark"))
    lines = F.split(F.col("text"), "\n")
    none = F.array().cast("array<int>")
    repeats = F.coalesce("repeats", none)
    if max_repeated is None:
        drops = F.col("__copy").isNull()
    else:
        size = F.aggregate(repeats, F.lit(0).cast("long"), lambda s, k: s + F.length(F.get(lines, k)))
        drops = size <= max_repeated * F.length("text")
    long_enough = F.filter(repeats, lambda k: F.length(F.get(lines, k)) >= min_dropped)
    dropped = F.when(drops, long_enough).otherwise(none)
    kept = F.array_join(F.filter(lines, lambda x, k: ~F.array_contains(F.col("dropped"), k)), "\n")
    return keyed.join(found, ["__doc", "__mark"], "left").withColumn("dropped", dropped).select(
        *keep, F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).alias("n_lines"), F.size(repeats).alias("n_repeats"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"), "dropped",
        F.when(F.size("dropped") == 0, F.col("text")).otherwise(kept).alias("kept_text"))
