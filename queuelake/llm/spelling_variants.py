"""Groups of spelling variants: words one inserted, deleted or replaced code point apart, by a bit-sliced position index.

1. `vocabulary` counts words in Spark; only words with their counts go on.
2. Two near words share their first or their last letters: with m the length of the shorter, one error leaves
   floor(m / 2) of them whole at one end. `filed` puts a word under both ends, once for m its own length and once for
   m one less. A list under one key holds words of lengths m and m + 1.
3. A list, most frequent word first, is cut into lanes of 64 words. The index says, for a position, a letter and a
   lane, which of its words have that letter there: one 64-bit set. Every word of the list is a query: set operations
   with the sets of its letters, at its own position and shifted by one to either side, keep for all words of a lane
   at once which equal the query so far and which do with one letter replaced, inserted or deleted (`near_sets`).
   A pair that shares both ends counts under the first only: the zero-error set after floor(m / 2) letters tells.
4. The number of near words is a count of bits; the most frequent of them is the first bit of the first lane. No pair
   of words becomes a row. Lists of more than `PART_WORDS` words are cut into parts by a hash, and each two parts meet
   in a group of their own, so no task holds a long list.
5. `rooted` follows forms to the last of the chain by jumps that double; counts rise along a chain, so it ends.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queuelake.llm import textbytes
from queuelake.llm.shared import BROADCAST_IDS, stored
from queuelake.session import prepare

RUN = r"[A-Za-zÀ-ÿ]"
MIN_LENGTH, MIN_COUNT = 6, 5
#: A form must be as many times as frequent as the word.
RATIO = 5
#: Every so manieth (document, word) loses a letter.
TYPO_EVERY = 199
#: Words of a list that are held as an index, and words of it that are queries, in one group.
PART_WORDS = 16_384
#: (query, lane) pairs whose sets are worked out at once; sets of (lane, letter) that an index has for a position.
PAIRS, CELLS = 1 << 17, 1 << 20
#: Filed words that a task is meant to hold.
TASK_WORDS = 200_000


def vocabulary(docs: DataFrame, typo_every: int | None = TYPO_EVERY, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """Rows (word, n): words of at least `min_length` code points with their number, if at least `min_count`.

    A word is a maximal run of Latin letters, A-Z in lower case; where `typo_every` divides the crc32 of
    `<doc_id>:<run>`, the code point at crc32 modulo the run's length is missing (None: nowhere). A null id is empty.
    """
    # Shorter runs give no word; the longest match at a run's first letter is the run.
    runs = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(f"{RUN}{{{min_length},}}"), F.lit(0))
    lowered = F.translate("run", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.explode(runs).alias("run")).select("doc", lowered.alias("run"))
    if typo_every:
        h = F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary"))
        at = (F.col("h") % F.length("run")).cast("int")
        rows = rows.withColumn("h", h).select(
            F.when(F.col("h") % typo_every == 0, F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))).otherwise(F.col("run")).alias("run")
        )
    counted = rows.where(F.length("run") >= min_length).groupBy(F.col("run").alias("word")).agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= min_count)


def filed(words: DataFrame) -> DataFrame:
    """Each word under its first and its last letters, as one of the shorter (m its length) and of the longer words (m one less)."""
    m = F.col("m")
    half = F.floor(m / 2).cast("int")
    end = F.when(F.col("head"), F.substring("word", F.lit(1), half)).otherwise(F.substring("word", F.length("word") - half + 1, half))
    ways = F.array(*[F.struct((F.length("word") - less).alias("m"), F.lit(head).alias("head")) for less in (0, 1) for head in (True, False)])
    # One-letter words have neighbours of two letters and share nothing with them: m is one or more, half of one is none.
    return words.select("word", "n", F.explode(ways).alias("w")).select("word", "n", "w.m", "w.head").where("m > 0").withColumn("key", F.xxhash64(m, "head", end))


def _or_into(size: int, at: np.ndarray, bits: np.ndarray) -> np.ndarray:
    table = np.zeros(size, np.uint64)
    np.bitwise_or.at(table, at, bits)
    return table


class Lanes:
    """The index of one list: for a position, the set of each (lane, letter)."""

    def __init__(self, codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, letters: int) -> None:
        self.codes, self.starts, self.lengths, self.letters = codes, starts, lengths, letters
        number = np.arange(len(starts))
        self.lane, self.bit = number >> 6, np.uint64(1) << (number & 63).astype(np.uint64)
        self.lanes = int(self.lane[-1]) + 1 if len(starts) else 0

    def at(self, position: int) -> np.ndarray:
        """Words that have each letter at the position, lane by lane; words that are shorter are in no set."""
        has = np.flatnonzero(self.lengths > position) if position >= 0 else np.empty(0, np.int64)
        cell = self.lane[has] * self.letters + self.codes[self.starts[has] + position]
        return _or_into(self.lanes * self.letters, cell, self.bit[has])

    def of_length(self, length: int) -> np.ndarray:
        has = self.lengths == length
        return _or_into(self.lanes, self.lane[has], self.bit[has])


def near_sets(index: Lanes, lane: np.ndarray, codes: np.ndarray, starts: np.ndarray, m: int, longer: bool, half: int, head: bool) -> np.ndarray:
    """For each (lane, query) the words of the lane that are near the query, one 64-bit set.

    Queries have m letters (m + 1 if `longer`), and start at `starts` in `codes`. Words of m and m + 1 letters are
    near queries of m; only words of m are near longer ones, since words of m + 1 meet in the list of m + 1.
    Of these, words that share the query's first `half` letters are returned if `head`, the others if not.
    """
    full = ~np.uint64(0)
    zero = np.full(len(lane), full)
    replaced, inserted, deleted = (np.zeros(len(lane), np.uint64) for _ in range(3))
    shared = zero
    before, here, after = index.at(-1), index.at(0), index.at(1)
    for i in range(m + longer):
        if i == half:
            shared = zero
        cell = lane * index.letters + codes[starts + i]
        same = here[cell]
        # One letter of the query is too many: from now on words are read one position before.
        deleted = (deleted & before[cell]) | zero
        if not longer:
            replaced = (replaced & same) | (zero & ~same)
            # One letter of the word is too many: from now on words are read one position behind.
            inserted = (inserted | zero) & after[cell]
        zero = zero & same
        before, here, after = here, after, index.at(i + 2)
    shorter, longer_words = index.of_length(m)[lane], index.of_length(m + 1)[lane]
    if longer:
        near = deleted & shorter
    else:
        near = (replaced & shorter) | ((inserted | zero) & longer_words)
    return near & (shared if head else ~shared)


_FOUND = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("near_n", pa.int64()), ("near_word", pa.string())])


def _codes(words: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Letters of all words as small numbers, and where each word starts; its length; how many letters there are."""
    points = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), np.uint32)
    known, codes = np.unique(points, return_inverse=True)
    lengths = pc.utf8_length(words).to_numpy().astype(np.int64)
    return codes.astype(np.int64), np.cumsum(lengths) - lengths, lengths, max(len(known), 1)


def _class(table: pa.Table, m: int, head: bool) -> pa.Table:
    """What the words of lists of one m and one end are near to. Rows are sorted by list and then as bits are given."""
    codes, starts, lengths, letters = _codes(table.column("word"))
    counts = table.column("n").to_numpy()
    as_index, as_query = table.column("as_index").to_numpy(zero_copy_only=False), table.column("as_query").to_numpy(zero_copy_only=False)
    first, size = textbytes.runs(table.column("key").to_numpy())
    # Words of a list get numbers that start at a lane; a list has the lanes from[list] to from[list] + of[list].
    list_of = np.repeat(np.arange(len(first)), size)
    word = np.flatnonzero(as_index)
    per_list = np.bincount(list_of[word], minlength=len(first))
    of = (per_list + 63) >> 6
    begin = np.cumsum(of) - of
    place = np.arange(len(word)) - np.repeat(np.cumsum(per_list) - per_list, per_list) + 64 * begin[list_of[word]]
    index = Lanes(codes, starts[word], lengths[word], letters)
    index.lane, index.bit, index.lanes = place >> 6, np.uint64(1) << (place & 63).astype(np.uint64), int(of.sum())
    at_place = np.full(64 * max(index.lanes, 1), -1)
    at_place[place] = word

    out: list[pa.Table] = []
    for longer in (False, True):
        query = np.flatnonzero(as_query & (lengths == m + longer))
        pairs = of[list_of[query]]
        ends = np.cumsum(pairs)
        done = 0
        while done < len(query):
            upto = max(done + 1, int(np.searchsorted(ends, ends[done] - pairs[done] + PAIRS, "right")))
            asked, each = query[done:upto], pairs[done:upto]
            done = upto
            if not each.sum():
                continue
            of_pair = np.repeat(np.arange(len(asked)), each)
            lane = np.repeat(begin[list_of[asked]], each) + np.arange(len(of_pair)) - np.repeat(np.cumsum(each) - each, each)
            near = near_sets(index, lane, codes, starts[asked][of_pair], m, longer, m // 2, head)
            hit = np.flatnonzero(near)
            if not len(hit):
                continue
            of_hit = of_pair[hit]
            head_of, _ = textbytes.runs(of_hit)
            total = np.add.reduceat(np.bitwise_count(near[hit]).astype(np.int64), head_of)
            # Bits are in order of frequency, so the first one of the first lane is the most frequent word.
            lowest = near[hit[head_of]]
            lowest &= ~lowest + np.uint64(1)
            best = at_place[64 * lane[hit[head_of]] + np.bitwise_count(lowest - np.uint64(1)).astype(np.int64)]
            words = table.column("word")
            columns = [words.take(pa.array(asked[of_hit[head_of]])), pa.array(total), pa.array(counts[best]), words.take(pa.array(best))]
            out.append(pa.Table.from_arrays(columns, schema=_FOUND))
    return pa.concat_tables(out) if out else _FOUND.empty_table()


def _near(table: pa.Table) -> pa.Table:
    """Near words within the lists of one group."""
    table = table.sort_by([("m", "ascending"), ("head", "ascending"), ("key", "ascending"), ("n", "descending"), ("word", "ascending")])
    table = table.combine_chunks()
    # A word alone in its list is near to nothing there; so long words, which hardly share an end, cost nothing.
    first, size = textbytes.runs(table.column("key").to_numpy())
    table = table.filter(pa.array(np.repeat(size > 1, size)))
    kinds = table.column("m").to_numpy().astype(np.int64) * 2 + table.column("head").to_numpy(zero_copy_only=False)
    found = [_FOUND.empty_table()]
    for begin, rows in zip(*(x.tolist() for x in textbytes.runs(kinds)), strict=True):
        part = table.slice(begin, rows)
        letters = len(set("".join(part.column("word").to_pylist())))
        first, size = textbytes.runs(part.column("key").to_numpy())
        cells = np.cumsum((size + 63 >> 6) * letters)
        at = 0
        while at < len(first):
            upto = max(at + 1, int(np.searchsorted(cells, (cells[at - 1] if at else 0) + CELLS, "right")))
            last = first[upto] if upto < len(first) else rows
            found.append(_class(part.slice(first[at], last - first[at]), int(kinds[begin]) // 2, bool(kinds[begin] & 1)))
            at = upto
    return pa.concat_tables(found)


def near_words(words: DataFrame, part_words: int = PART_WORDS) -> DataFrame:
    """For stored (word, n) with distinct words: word, n_near, and near_n and near_word, the most frequent near word
    (ties: the first in code-point order). Words with no near word are left out."""
    listed = filed(words)
    long = stored(listed.groupBy("key").agg(F.count("*").alias("size")).where(F.col("size") > part_words), "long-lists")
    long = F.broadcast(long) if long.count() <= BROADCAST_IDS else long
    # Lists are dealt to groups of many lists each; two parts of a long list are a group of their own.
    groups = max(1, -(-4 * words.count() // TASK_WORDS))
    parts = F.ceil(F.coalesce("size", F.lit(0)) / part_words).cast("int")
    listed = listed.join(long, "key", "left").withColumn("parts", F.greatest(parts, F.lit(1))).withColumn("part", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
    other = F.sequence(F.lit(0), F.col("parts") - 1)
    whole = listed.where("parts = 1").select(F.pmod(F.col("key"), F.lit(groups)).alias("dealt"), F.lit(0).alias("x"), F.lit(0).alias("y"), "key", "m", "head", "word", "n", F.lit(True).alias("as_index"), F.lit(True).alias("as_query"))
    ways = F.concat(
        F.transform(other, lambda o: F.struct(F.col("part").alias("x"), o.alias("y"), F.lit(True).alias("as_index"), (F.col("part") == o).alias("as_query"))),
        F.transform(F.filter(other, lambda o: o != F.col("part")), lambda o: F.struct(o.alias("x"), F.col("part").alias("y"), F.lit(False).alias("as_index"), F.lit(True).alias("as_query"))),
    )
    cut = listed.where("parts > 1").select("key", "m", "head", "word", "n", F.explode(ways).alias("w"))
    cut = cut.select(F.col("key").alias("dealt"), "w.x", "w.y", "key", "m", "head", "word", "n", "w.as_index", "w.as_query")
    met = whole.union(cut).groupBy("dealt", "x", "y").applyInArrow(_near, "word string, n_near bigint, near_n bigint, near_word string")
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), "near_word"))
    return met.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select("word", "n_near", (-F.col("best.minus")).alias("near_n"), "best.near_word")


def rooted(forms: DataFrame) -> DataFrame:
    """Adds root to stored (word, form, ...): the last word reached by forms, the word itself if its form is null."""
    at = stored(forms.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = stored(at.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        at = step.drop("moved")
        if step.where("moved").isEmpty():
            break
    return forms.join(at, "word", "left").withColumn("root", F.coalesce("root", "word"))


def variants(words: DataFrame, ratio: int = RATIO, part_words: int = PART_WORDS) -> DataFrame:
    """One row per word of (word, n): word, form, root, n, n_near, form_n.

    Two words are near if they differ by exactly one inserted, deleted or replaced code point. form is the near word
    of largest n (ties: the first in code-point order) if its n is at least `ratio` times the word's, else null.
    Words are distinct; a null or empty word and a null n are left out, as they are no words. No rows give no rows.
    """
    prepare(words.sparkSession)
    words = stored(words.select("word", "n").where("word <> '' AND n IS NOT NULL"), "vocabulary")
    joined = words.join(near_words(words, part_words), "word", "left")
    is_form = F.col("near_n") >= ratio * F.col("n")
    forms = joined.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("near_word")).alias("form"), F.when(is_form, F.col("near_n")).alias("form_n"))
    return rooted(stored(forms, "forms")).select("word", "form", "root", "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """Spelling variants of the words of `doc_id, text`; see `vocabulary` and `variants`.

    Null and empty texts have no words. Rows that repeat are counted each. Other columns are not read.
    """
    prepare(docs.sparkSession)
    return variants(vocabulary(docs.select("doc_id", "text")))
