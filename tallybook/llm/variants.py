"""Spelling variants of words: words one edit apart, found by pivotal grams.

A word's bigrams stand at positions and are ordered by rarity (the number of words
that have them). One edit touches at most two bigrams that overlap, so of two disjoint
bigrams of a word at least one is found whole in any word one edit away. Each word
therefore gets two disjoint bigrams, its pivots, and looks for them in the
prefixes of others: a prefix holds a word's rarest bigrams up to the rank of the
third. Of two near words, the pivots of the one whose prefix ends earlier in
the order lie in the other's prefix, so every near pair meets at least once. The
pivots are the disjoint pair of the prefix that fewest words have, by dynamic programming.

An edit moves what follows it by one place at most and says by how much the lengths differ, and it
leaves equal all that stands on the other side of the bigram. So position, length and the word's part before or
behind the bigram are in the key of the join. What meets is verified by the edit distance itself.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.functions.storage import store

# What words are made of, the divisor that picks runs to be damaged, A-Z.
LETTERS = r"A-Za-zÀ-ÿ"
DAMAGED = 199
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

GRAM = 2
PIVOTS = 2  # one edit, one more than it can destroy
PREFIX = GRAM * 1 + 1  # any so many bigrams hold two disjoint ones
# Where one edit lies between two words: how the other differs in length, by how much a bigram has moved in it, and what
# of the two is then equal, all before the bigram or all behind it. Replaced, inserted, deleted; behind, then before.
SHIFTS = ((0, 0, "head"), (0, 0, "tail"), (1, 0, "head"), (1, 1, "tail"), (-1, 0, "head"), (-1, -1, "tail"))
MOST_GRAMS = 100_000  # distinct bigrams; the 90 symbols above make at most 8,100


def words_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 6, least: int = 5) -> DataFrame:
    """word, n: the words of whole texts with at least ``least_length`` code points and ``least`` occurrences.

    Runs of letters with A-Z in lower case; where 199 divides the CRC-32 of ``<doc_id>:<run>``, the run
    loses the code point at that number modulo its length. Sums are taken before rows move.
    """
    found = F.regexp_extract_all(F.col(text_col).cast("string"), F.lit(f"[{LETTERS}]{{{least_length},}}"), F.lit(0))
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("doc"), F.explode(found).alias("run"))
    runs = runs.select("doc", F.translate("run", UPPER, LOWER).alias("run"))
    h = F.crc32(F.concat_ws(":", "doc", "run").cast("binary"))
    at = (h % F.char_length("run") + 1).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), at - 1), F.substring(F.col("run"), at + 1, F.char_length("run")))
    words = runs.select(F.when(h % DAMAGED == 0, cut).otherwise(F.col("run")).alias("word"))
    words = words.filter(F.char_length("word") >= least_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)


def pivots(prefix: Sequence[tuple[int, int]]) -> list[int]:
    """Indices in ``prefix`` (position, weight; by position) of PIVOTS disjoint bigrams of the least total weight.

    ``best[j]`` is the cheapest choice of j bigrams among those read so far, ``ended[j]`` the same among those that
    end before the present one; ties go to the earlier choice.
    """
    none = (math.inf, ())
    best: list[tuple[float, tuple[int, ...]]] = [(0.0, ())] + [none] * PIVOTS
    at_step = [list(best)]  # after so many bigrams
    for i, (place, weight) in enumerate(prefix):
        clear = i
        while clear and prefix[clear - 1][0] > place - GRAM:
            clear -= 1
        before, best = at_step[clear], list(best)
        for j in range(1, PIVOTS + 1):
            best[j] = min(best[j], (before[j - 1][0] + weight, (*before[j - 1][1], i)))
        at_step.append(best)
    return list(best[PIVOTS][1])


def grams_of(word: str, rank: Mapping[str, int], weight: Mapping[str, int]) -> tuple[list[tuple[str, int]], list[tuple[str, int]]]:
    """(prefix, pivots) of a word: bigrams and their positions.

    The prefix ends with the bigram of third lowest rank, with all occurrences of that bigram.
    """
    grams = [(word[i : i + GRAM], i) for i in range(len(word) - GRAM + 1)]
    last = sorted(rank[g] for g, _ in grams)[PREFIX - 1]
    prefix = [(g, i) for g, i in grams if rank[g] <= last]
    return prefix, [prefix[k] for k in pivots([(i, weight[g]) for g, i in prefix])]


def near_words(words: DataFrame) -> DataFrame:
    """(word, other), both ways, for all pairs of distinct ``words`` (column word) exactly one edit apart.

    Words need 4 code points at least: shorter ones have no two disjoint bigrams in any prefix.
    """
    words = words.select("word").distinct()
    of_word = F.transform(F.sequence(F.lit(1), F.char_length("word") - 1), lambda i: F.col("word").substr(i, F.lit(GRAM)))
    grams = words.select(F.explode(F.array_distinct(of_word)).alias("gram"))
    # One row for each bigram there is; letters of a fixed set make a fixed number of them.
    counted = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).orderBy("n", "gram").limit(MOST_GRAMS + 1).collect()
    if len(counted) > MOST_GRAMS:
        raise ValueError(f"more than {MOST_GRAMS} distinct bigrams")
    weight = {r.gram: r.n for r in counted}
    rank = {r.gram: i for i, r in enumerate(counted)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[str, str, int, bool]] = []
            for word in batch.column(0).to_pylist():
                prefix, chosen = grams_of(word, rank, weight)
                out += [(word, g, i, (g, i) in chosen) for g, i in prefix]
            columns = list(zip(*out)) or [[]] * 4
            kinds = (pa.string(), pa.string(), pa.int32(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["word", "gram", "place", "pivot"])

    prefixes = store(words.mapInArrow(run, "word string, gram string, place int, pivot boolean"), "grams")
    length = F.char_length("word")

    def rest(side: Column) -> Column:
        head, tail = F.col("word").substr(F.lit(1), F.col("place")), F.col("word").substr(F.col("place") + GRAM + 1, length)
        return F.xxhash64(side, F.when(side == "head", head).otherwise(tail)).alias("rest")

    sides = F.explode(F.array(F.lit("head"), F.lit("tail"))).alias("side")
    index = prefixes.select("word", "gram", "place", length.alias("length"), sides)
    index = index.select(F.col("word").alias("other"), "gram", "place", "length", rest(F.col("side")))
    names = ("longer", "later", "side")
    moved = F.explode(F.array(*[F.struct(*[F.lit(x).alias(n) for x, n in zip(shift, names)]) for shift in SHIFTS])).alias("moved")
    seeks = prefixes.filter("pivot").select("word", "gram", "place", moved).select(
        "word", "gram", (F.col("place") + F.col("moved.later")).alias("place"),
        (length + F.col("moved.longer")).alias("length"), rest(F.col("moved.side")),
    )
    met = seeks.join(index, ["gram", "place", "length", "rest"]).filter(F.col("word") != F.col("other"))
    one_way = met.filter(F.levenshtein("word", "other", 1) == 1).select(
        F.least("word", "other").alias("word"), F.greatest("word", "other").alias("other")
    )
    one_way = store(one_way.distinct(), "near")
    return one_way.union(one_way.select("other", "word"))


def _roots(forms: DataFrame) -> DataFrame:
    """word, root for words with a form: the end of the chain word, form, form of the form, ..

    Each round doubles the steps taken. A form is at least five times as frequent as its word, so
    a chain of k steps needs a word of 5^k occurrences and the rounds are few.
    """
    table = store(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = table.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = table.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        moved = store(moved, "roots")
        table = moved.select("word", "root")
        if not moved.filter("moved").limit(1).count():
            return table


def variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 6, least: int = 5, times: int = 5
) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of ``docs`` (see ``words_of``).

    ``n_near`` counts the words exactly one inserted, deleted or replaced code point away. ``form`` is the most
    frequent of them (ties: the first in code-point order) if it is at least ``times`` as frequent as the word, else null;
    ``root`` is where the forms lead to, the word itself without any.

    A null text has no words. A null id reads as empty in the checksum. Repeated rows count as often as they
    occur. An empty table, or one without such words, gives an empty result. Other columns are not looked at.
    """
    if least_length < GRAM * 1 + 2:
        raise ValueError("words need 4 code points at least")
    if times < 2:
        raise ValueError("a form must be more frequent than its word")
    words = store(words_of(docs, id_col, text_col, least_length, least), "words")
    near = near_words(words).join(words.withColumnsRenamed({"word": "other", "n": "other_n"}), "other")
    first = F.min_by(F.struct("other", "other_n"), F.struct(-F.col("other_n"), "other"))
    best = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), first.alias("best"))
    enough: Column = F.col("best.other_n") >= times * F.col("n")
    judged = words.join(best, "word", "left").select(
        "word",
        F.when(enough, F.col("best.other")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(enough, F.col("best.other_n")).alias("form_n"),
    )
    judged = store(judged, "judged")
    roots = _roots(judged.filter("form is not null"))
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
