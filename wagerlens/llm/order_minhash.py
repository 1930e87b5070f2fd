"""Document fingerprints that follow edit distance: order minimum hashing, in column functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wagerlens.llm.common import partitions

_POSITION = 24  # low bits of a packed number hold a position, the others a hash
_LAST = (1 << _POSITION) - 1


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def _hash_of(packed: Column) -> Column:
    return F.shiftrightunsigned(packed, _POSITION)


def _pack(hashed: Column, position: Column) -> Column:
    return hashed.bitwiseAND(F.lit(~_LAST)).bitwiseOR(position.cast("long"))


def signature(text: Column, sketches: int = 24, tuple_size: int = 2, words: int = 3, characters: int = 5, unspaced: int = 24) -> Column:
    """`sketches` numbers for a whole text; equal texts have equal ones.

    A text's units are its words; a word of `unspaced` characters or more is that many units of one character. A k-mer is
    `words` units in a row, or `characters` of them if the first is a single character; the last ones of a text are as long
    as it lasts, and a text with fewer than `words` units is one k-mer. What a k-mer is depends on its place alone and not on the text's
    length, so texts of any lengths share those of equal passages. A k-mer that occurs again is numbered, so repeated ones stay apart.

    Hashes of k-mer and number lie on a circle. Each sketch has its own place there, orders all k-mers of the text from that place on,
    takes the `tuple_size` first (all, if there are fewer), puts them back into the order of the text and hashes the tuple. Two texts
    agree in a sketch if the first k-mers of both together are shared and in the same order.

    Numbers are found by sorting (hash, position) pairs: equal k-mers form a run, in text order, and are numbered along it. The
    sketches' places are sorted in with the k-mers, so one more sort finds what follows each. Hashes have 40 bits here; positions
    beyond 2^24 count as one.
    """
    spaced = F.split(text, r"[ \t\n\x0B\f\r]+")
    units = F.flatten(F.transform(spaced, lambda w: F.when(F.length(w) < unspaced, F.array(w)).otherwise(F.split(w, ""))))
    places = F.array(*[F.lit(x) for x in circle(sketches)])

    def kmers(u: Column) -> Column:
        at = F.sequence(F.lit(1), F.greatest(F.size(u) - words + 1, F.lit(1)))
        many = lambda i: F.when(F.length(F.get(u, i - 1)) == 1, characters).otherwise(words)
        return F.transform(at, lambda i: _pack(F.xxhash64(F.slice(u, i, many(i))), F.least(i, F.lit(_LAST))))

    def numbered(s: Column) -> Column:
        def again(x: Column, j: Column) -> Column:
            return (j > 0) & (_hash_of(F.get(s, j - 1)) == _hash_of(x))

        firsts = F.filter(s, lambda x, j: ~again(x, j))
        return _let(F.filter(s, again), lambda r: F.when(F.size(r) == 0, firsts).otherwise(F.concat(firsts, repeats(r))))

    def repeats(r: Column) -> Column:
        def begins(j: Column) -> Column:
            return (j == 0) | (_hash_of(F.get(r, j - 1)) != _hash_of(F.get(r, j)))

        def element(x: Column, number: Column) -> Column:
            return _pack(F.xxhash64(_hash_of(x), number), x.bitwiseAND(F.lit(_LAST)))

        def runs(starts: Column) -> Column:
            end = lambda i: F.coalesce(F.get(starts, i + 1), F.size(r))
            return F.flatten(F.transform(starts, lambda start, i: F.transform(F.slice(r, start + 1, end(i) - start), element)))

        return _let(F.filter(F.sequence(F.lit(0), F.size(r) - 1), begins), runs)

    def is_place(x: Column) -> Column:
        return x.bitwiseAND(F.lit(_LAST)) == 0  # positions of k-mers begin at 1

    def sketched(all_of_them: Column, around: Column) -> Column:
        n = F.size(all_of_them)
        steps = F.sequence(F.lit(0), F.least(F.lit(tuple_size), n) - 1)

        def sketch(j: Column, i: Column) -> Column:  # the i-th place, at j among k-mers and places, so j - i k-mers are before it
            found = F.transform(steps, lambda step: F.get(all_of_them, F.pmod(j - i + step, n)))
            by_place = F.sort_array(F.transform(found, lambda x: F.shiftleft(x.bitwiseAND(F.lit(_LAST)), 40 - 1).bitwiseOR(F.shiftrightunsigned(x, _POSITION + 1))))
            return F.xxhash64(F.transform(by_place, lambda x: x.bitwiseAND(F.lit((1 << 39) - 1))))

        return F.transform(F.filter(F.sequence(F.lit(0), F.size(around) - 1), lambda j: is_place(F.get(around, j))), sketch)

    around = _let(units, lambda u: _let(F.sort_array(kmers(u)), lambda s: F.sort_array(F.concat(numbered(s), places))))
    return _let(around, lambda m: _let(F.filter(m, lambda x: ~is_place(x)), lambda k: sketched(k, m)))


def circle(sketches: int) -> list[int]:
    """Ascending places of the sketches among all signed 64-bit numbers, at equal distances, with room for a position below."""
    return [(-(1 << 63) + (i << 64) // sketches) & ~_LAST for i in range(sketches)]


def likeness(a: Column, b: Column) -> Column:
    """Share of equal sketches, 0 to 1."""
    equal = F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same)
    return F.size(equal) / F.size(a)


def text_of(sketches: Column) -> Column:
    """A signature as text, 16 hexadecimal digits for each sketch."""
    return F.array_join(F.transform(sketches, lambda x: F.lower(F.lpad(F.hex(x), 16, "0"))), "")


def _ranges(docs: DataFrame, at: Column, pieces: int) -> list[int]:
    """The least id, and ids of `docs` that cut them into `pieces` ranges of about equal numbers."""
    cuts = [i / pieces for i in range(pieces)]
    return sorted(set(docs.select(F.percentile_approx(at, cuts, 10_000).alias("cuts")).first().cuts or []))


def _range_of(at: Column, starts: list[int]) -> Column:
    """How many of the sorted `starts`, from the second, are not above `at`: looked up among every n-th, then between those."""
    wide = max(1, int(len(starts) ** 0.5))
    parts = [starts[i : i + wide] for i in range(0, len(starts), wide)]
    many = lambda some: F.size(F.filter(some, lambda x: x <= at))
    coarse = F.greatest(many(F.array(*[F.lit(p[0]) for p in parts])), F.lit(1))
    fine = F.array(*[F.array(*[F.lit(x) for x in p]) for p in parts])
    return _let(coarse, lambda c: F.greatest((c - 1) * wide + many(F.get(fine, c - 1)) - 1, F.lit(0)))


def edited_fingerprints(docs: DataFrame, **settings) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row of `docs`.

    A row's edited text has its last quarter (rounded down) replaced by the first as many code points of
    the next row by ascending doc_id; after the last comes the first. Rows without an id come first, rows that
    repeat an id are ordered by text. A single row is its own next. Null text counts as empty. No rows, no result.

    Rows are dealt into ranges of ids that hold about as many rows each; the first of a range also goes to
    the range before, as the one that comes next. So each range finds its neighbours by itself.
    """
    spark = docs.sparkSession
    whole = docs.select(
        "doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("at"), F.coalesce(F.col("text"), F.lit("")).alias("text")
    )
    starts = _ranges(whole.select("at"), F.col("at"), partitions(spark)) or [0]
    last = len(starts) - 1
    own, here = F.struct(F.col("range").alias("range"), F.lit(0).alias("guest")), F.col("range")
    first = F.array_contains(F.array(*[F.lit(x) for x in starts]), F.col("at"))
    visit = F.struct(F.when(here == 0, F.lit(last)).otherwise(here - 1).alias("range"), F.when(here == 0, 2).otherwise(1).alias("guest"))
    dealt = (
        whole.withColumn("range", _range_of(F.col("at"), starts)).withColumn("sketches", signature(F.col("text"), **settings))
        .withColumn("to", F.explode(F.when(first, F.array(own, visit)).otherwise(F.array(own))))
        .select("doc_id", "at", "text", "sketches", "to.range", "to.guest")
    )
    order = Window.partitionBy("range").orderBy("guest", "at", "text")
    follows = F.lead(F.struct("text", "sketches")).over(order)
    quarter = (F.col("n_chars") / 4).cast("int")
    pairs = (
        dealt.withColumn("next", follows).where("guest = 0").withColumn("n_chars", F.length("text"))
        .select(
            "doc_id", F.col("n_chars").cast("long").alias("n_chars"), "sketches", F.col("next.sketches").alias("next"),
            F.concat(F.substr("text", F.lit(1), F.col("n_chars") - quarter), F.substr("next.text", F.lit(1), quarter)).alias("edited"),
        )
    )
    return pairs.withColumn("changed", signature(F.col("edited"), **settings)).select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        text_of(F.col("sketches")).alias("fingerprint"), text_of(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("sketches"), F.col("changed")).alias("near_edited"), likeness(F.col("sketches"), F.col("next")).alias("near_next"),
    )
