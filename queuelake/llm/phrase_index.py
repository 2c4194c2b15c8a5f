"""Benchmark decontamination: a positional inverted index of the documents, and phrases found in it.

1. `postings` stores one row (term, rid, pos) for each word of a document that the test items use. An index is made of
   segments: each task sorts the postings of its own documents by term, so no word, however common, is shuffled, and
   a scan for a few terms skips the pages of the others. A posting of `END` per document holds its number of words.
2. `windows` cuts the items into their distinct phrases. Terms of a phrase are ordered by the length of their lists.
3. `phrases` starts from the list of each phrase's rarest term and moves its positions by the distance to the next
   rarest: where that term's list has the moved position, the phrase may stand. Phrases that share the two terms at
   the same distance share this step. What is left is held against the lists of all further terms of the phrase.
4. `proximity` finds, from the same lists, places where all terms of a phrase stand within some words in any order.

Only DataFrame functions are used. Terms are numbers of the exact strings; no hash decides a match. Terms and phrases
of the items go to every task while they are fewer than `BROADCAST_ROWS`; beyond that they are joined by a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from queuelake.llm.shared import stored, with_ids
from queuelake.session import prepare

#: A word of text in which A-Z are lower-cased already: digits, a-z and everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
#: Term of the posting that holds a document's number of words.
END = -1
#: Most rows of items' terms or phrases that are sent to every task (some 100 bytes each).
BROADCAST_ROWS = 500_000


def words(text: Column) -> Column:
    """The words of a text, A-Z in lower case; null has none."""
    lowered = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def _few(rows: DataFrame) -> DataFrame:
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def windows(items: DataFrame, size: int = WINDOW) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Terms (word, term), phrases (phrase, off, term, length) and their items (phrase, item_id), each distinct and stored.

    A phrase is `size` words in a row; an item of fewer words, but not none, is one phrase. Items that repeat an id
    are one item with the phrases of all; a null id is an id of its own, the empty text.
    """
    listed = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), words(F.col("text")).alias("ws")).where("size(ws) > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.size("ws") - size + 1, F.lit(1)))
    cut = listed.select("item_id", F.explode(F.transform(starts, lambda at: F.slice("ws", at, size))).alias("phrase_words"))
    cut = stored(cut.distinct(), "item-phrases")
    # Equal phrases of several items are one phrase; numbers are stored once, so they stay as they are.
    phrases = stored(cut.select("phrase_words").distinct().select(F.monotonically_increasing_id().alias("phrase"), "phrase_words"), "phrases")
    terms = phrases.select(F.explode("phrase_words").alias("word")).distinct().select("word", F.monotonically_increasing_id().alias("term"))
    terms = stored(terms, "terms")
    placed = phrases.select("phrase", F.size("phrase_words").alias("length"), F.posexplode("phrase_words").alias("off", "word"))
    placed = stored(placed.join(_few(terms), "word").select("phrase", "off", "term", "length"), "phrase-terms")
    return terms, placed, stored(cut.join(phrases, "phrase_words").select("phrase", "item_id"), "phrase-items")


def postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """The stored index of `doc_id, text`: rows (term, rid, pos, doc_id), sorted by term in each segment.

    `rid` numbers the rows of the input, so rows that repeat a doc_id stay apart. Words that no term names are left
    out. The posting of `END` has the number of all words as its position, and alone carries the doc_id.
    """
    numbered = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", words(F.col("text")).alias("ws"))
    # The end is one more element behind the words, null as no word is.
    marked = numbered.select("rid", "doc_id", F.posexplode(F.concat("ws", F.array(F.lit(None).cast("string")))).alias("pos", "word"))
    found = marked.join(_few(terms), "word", "left").where("term IS NOT NULL OR word IS NULL")
    filed = found.select(F.coalesce("term", F.lit(END)).alias("term"), "rid", "pos", F.when(F.col("word").isNull(), F.col("doc_id")).alias("doc_id"))
    return stored(filed.sortWithinPartitions("term"), "postings")


def by_rarity(index: DataFrame, placed: DataFrame) -> DataFrame:
    """Terms of each phrase with their turn, the rarest first (turn 1); phrases with a term that has no list are left out."""
    lengths = index.groupBy("term").agg(F.count("*").alias("listed"))
    counted = placed.join(_few(stored(lengths.where(f"term <> {END}"), "list-lengths")), "term")
    # A phrase has at most as many rows as words.
    turn = F.row_number().over(W.partitionBy("phrase").orderBy("listed", "off"))
    whole = F.count("*").over(W.partitionBy("phrase")) == F.col("length")
    return stored(counted.select("phrase", "off", "term", "length", "listed", turn.alias("turn"), whole.alias("whole")).where("whole").drop("whole"), "phrase-turns")


def _lists(index: DataFrame, terms: DataFrame) -> DataFrame:
    """Postings of some terms."""
    return index.join(_few(stored(terms.distinct(), "list-terms")), "term", "left_semi").select("term", "rid", "pos")


def phrases(index: DataFrame, placed: DataFrame) -> DataFrame:
    """Where phrases stand, exactly: rows (rid, start, phrase, length), stored."""
    turns = by_rarity(index, placed)
    first = turns.where("turn = 1").select("phrase", "length", F.col("off").alias("off_1"), F.col("term").alias("term_1"))
    second = turns.where("turn = 2").select("phrase", F.col("off").alias("off_2"), F.col("term").alias("term_2"))
    pairs = first.join(second, "phrase", "left").select("*", (F.col("off_2") - F.col("off_1")).alias("gap"))
    # A probe is two terms at a distance, of whichever phrases.
    probes = stored(pairs.where("term_2 IS NOT NULL").select("term_1", "term_2", "gap").distinct(), "probes")
    moved = index.select("term", "rid", "pos").join(_few(probes.withColumnRenamed("term_1", "term")), "term")
    moved = moved.select("rid", F.col("term").alias("term_1"), F.col("term_2").alias("term"), "gap", (F.col("pos") + F.col("gap")).alias("pos")).where("pos >= 0")
    met = moved.join(_lists(index, probes.select(F.col("term_2").alias("term"))), ["rid", "pos", "term"])
    met = stored(met.select("rid", (F.col("pos") - F.col("gap")).alias("at"), "term_1", F.col("term").alias("term_2"), "gap"), "met")
    of_two = met.join(_few(pairs.where("term_2 IS NOT NULL")), ["term_1", "term_2", "gap"])
    single = pairs.where("term_2 IS NULL")
    of_one = index.select("rid", F.col("pos").alias("at"), F.col("term").alias("term_1")).join(_few(single), "term_1")
    placing = ["rid", (F.col("at") - F.col("off_1")).alias("start"), "phrase", "length"]
    open_ = stored(of_two.select(*placing).union(of_one.select(*placing)).where("start >= 0"), "open-phrases")

    rest = turns.where("turn > 2").select("phrase", "off", "term")
    asked = open_.where("length > 2").join(_few(rest), "phrase").select("rid", "start", "phrase", "length", (F.col("start") + F.col("off")).alias("pos"), "term")
    near = with_ids(_lists(index, rest.select("term")), stored(open_.where("length > 2").select("rid").distinct(), "open-rows"), "rid")
    held = asked.join(near, ["rid", "pos", "term"]).groupBy("rid", "start", "phrase", "length").agg(F.count("*").alias("held"))
    return stored(held.where("held = length - 2").drop("held").union(open_.where("length <= 2")), "phrase-hits")


def proximity(index: DataFrame, placed: DataFrame, within: int) -> DataFrame:
    """Where all terms of a phrase stand among `within` words, in any order: rows (rid, phrase, first, last).

    first and last bound the starts of such stretches; stretches that start side by side are one row. A term that a
    phrase has twice must stand twice. Starts may lie before the first word (negative), when the terms stand early.
    """
    turns = by_rarity(index, placed)
    needed = turns.groupBy("phrase", "term").agg(F.count("*").alias("times"), F.min("turn").alias("turn"))
    kinds = needed.groupBy("phrase").agg(F.count("*").alias("kinds"))
    rarest = needed.where("turn = 1").select("phrase", F.col("term").alias("anchor"))
    anchors = index.select("rid", "pos", F.col("term").alias("anchor")).join(_few(rarest), "anchor")
    # Every stretch that holds the rarest term starts at most within - 1 words before it.
    starts = anchors.select("rid", "phrase", F.explode(F.sequence(F.col("pos") - (within - 1), F.col("pos"))).alias("start")).distinct()
    # The same term may serve many phrases; a posting reaches the starts of stretches that hold it.
    reach = _lists(index, needed.select("term")).join(_few(needed.select("phrase", "term", "times")), "term")
    reach = with_ids(reach, stored(anchors.select("rid").distinct(), "anchor-rows"), "rid")
    covered = reach.select("rid", "phrase", "term", "times", F.explode(F.sequence(F.col("pos") - (within - 1), F.col("pos"))).alias("start"))
    counted = covered.join(starts, ["rid", "phrase", "start"]).groupBy("rid", "phrase", "start", "term", "times").agg(F.count("*").alias("n")).where("n >= times")
    full = counted.groupBy("rid", "phrase", "start").agg(F.count("*").alias("found")).join(_few(kinds), "phrase").where("found = kinds")
    island = F.col("start") - F.row_number().over(W.partitionBy("rid", "phrase").orderBy("start"))
    return full.select("rid", "phrase", "start", island.alias("island")).groupBy("rid", "phrase", "island").agg(F.min("start").alias("first"), F.max("start").alias("last")).drop("island")


def contamination(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    Words are hit that lie in any occurrence of a phrase of `size` words of an item (the whole item, if shorter).
    Null and empty texts have no words; rows that repeat a doc_id, or have none, each get their row. Items without
    words have no phrase. Only doc_id and text, item_id and text are read; no rows give no rows.
    """
    prepare(docs.sparkSession)
    terms, placed, of_items = windows(items.select("item_id", "text"), size)
    index = postings(docs.select("doc_id", "text"), terms)
    hits = phrases(index, placed)
    # A document's hits are at most one phrase of each length at each of its words.
    covered = hits.select("rid", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("length") - 1)).alias("pos")).distinct()
    n_hit = covered.groupBy("rid").agg(F.count("*").alias("n_hit"))
    of_doc = hits.select("rid", "phrase").distinct().join(_few(of_items), "phrase").select("rid", "item_id").distinct()
    n_items = of_doc.groupBy("rid").agg(F.count("*").alias("n_items"), F.array_join(F.array_sort(F.collect_list("item_id")), ",").alias("ids"))
    found = stored(n_hit.join(n_items, "rid"), "contaminated")
    rows = index.where(f"term = {END}").select("rid", "doc_id", F.col("pos").cast("bigint").alias("n_words"))
    return rows.join(_few(found), "rid", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.sha2(F.coalesce("ids", F.lit("")).cast("binary"), 256).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )
