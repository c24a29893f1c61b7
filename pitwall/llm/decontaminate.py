"""Benchmark decontamination by a prefix-filtered set join; DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from pitwall.llm.columns import free_name, plain_words
from pitwall.sources.scratch import staged

#: Words of a shingle; a shorter window is one shingle.
SHINGLE = 3
#: Bits of the hash bitmap: so many per token, within these bounds. It only thins out what is joined; the join is exact.
BITS_PER_TOKEN, LEAST_BITS, MOST_BITS = 512, 1 << 16, 1 << 24


def _hash(words: Column, at: Column, length: int) -> Column:
    return F.xxhash64(*(F.get(words, at + i) for i in range(length)))


def windows(benchmark: DataFrame, window: int, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Different (item_id, words): the runs of `window` words of every item, or all words of a shorter item. Items without words have none."""
    items = benchmark.select(F.col(f"`{item_id}`").alias("item_id"), plain_words(F.col(f"`{text}`")).alias("all_words")).filter(F.size("all_words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("all_words") - window + 1, F.lit(1)))
    return items.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("all_words", i, window))).alias("words")).distinct()


def _shingles(words: Column) -> Column:
    """Structs (hash, at, length) of a window's shingles."""

    def of_length(n: int) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(words) - n), lambda i: F.struct(_hash(words, i, n).alias("hash"), i.alias("at"), F.lit(n).alias("length")))

    out = F.when(F.size(words) >= SHINGLE, of_length(SHINGLE))
    for n in range(1, SHINGLE):
        out = out.when(F.size(words) == n, of_length(n))
    return out


class _Bitmap:
    """A few bits of the hashes of tokens, as a literal of bounded size: tells for most hashes of a text that they are no token's."""

    def __init__(self, tokens: DataFrame):
        """tokens: rows (hash, length)."""
        counts = {r["length"]: r["n"] for r in tokens.groupBy("length").agg(F.count("*").alias("n")).collect()}
        self.lengths, bits = sorted(counts) or [SHINGLE], LEAST_BITS
        while bits < min(sum(counts.values()) * BITS_PER_TOKEN, MOST_BITS):
            bits *= 2
        self.words = bits // 64
        filled = tokens.groupBy(self._word(F.col("hash")).alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), self._bit(F.col("hash")))).alias("bits"))
        values = ["0"] * self.words
        for r in filled.collect():
            values[r["word"]] = str(r["bits"])
        self.literal = F.split(F.lit(",".join(values)), ",").cast("array<bigint>")

    def _word(self, h: Column) -> Column:
        return F.shiftrightunsigned(h, 6).bitwiseAND(F.lit(self.words - 1)).cast("int")

    def _bit(self, h: Column) -> Column:
        return h.bitwiseAND(F.lit(63)).cast("int")

    def holds(self, h: Column) -> Column:
        return F.call_function("shiftrightunsigned", F.get(self.literal, self._word(h)), self._bit(h)).bitwiseAND(F.lit(1)) == 1

    def places(self, words: Column, then: Callable[[Column, int], Column]) -> Column:
        """`then(position, length)` for every shingle of `words` whose hash may be a token's, as one array."""

        def of_length(n: int) -> Column:
            starts = F.sequence(F.lit(0), F.size(words) - n)
            return F.when(F.size(words) >= n, F.transform(F.filter(starts, lambda i: self.holds(_hash(words, i, n))), lambda i: then(i, n)))

        return F.flatten(F.array_compact(F.array(*(of_length(n) for n in self.lengths))))


def rarest_shingles(words: DataFrame, wins: DataFrame) -> DataFrame:
    """Each window (item_id, words) with its shingle (hash, at, length) that occurs least often in all documents; of equals the least hash, then the first."""
    shingles = wins.select("item_id", "words", F.posexplode(_shingles(F.col("words"))).alias("nth", "s")).select("item_id", "words", "s.*")
    tokens = shingles.select("hash", "length").distinct()
    bitmap = _Bitmap(tokens)
    seen = words.select(F.explode(bitmap.places(F.col("words"), lambda i, n: _hash(F.col("words"), i, n))).alias("hash"))
    counts = seen.groupBy("hash").agg(F.count("*").alias("n"))
    order = F.struct(F.coalesce("n", F.lit(0)).alias("n"), "hash", "at", "length")
    rarest = shingles.join(counts, "hash", "left").groupBy("item_id", "words").agg(F.min(order).alias("prefix"))
    return rarest.select("item_id", "words", "prefix.hash", "prefix.at", "prefix.length")


def occurrences(docs: DataFrame, benchmark: DataFrame, window: int = 10, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id") -> tuple[DataFrame, DataFrame]:
    """(documents, hits): rows (doc_id, t, n_words) for every row of `docs`, and rows (doc_id, t, item_id, start, n) for every place where a window
    of an item occurs; t is a hash of the text.

    A window occurs only where all its shingles do, so its necessary prefix is one shingle: the rarest. Documents are read twice, to count the
    shingles of all windows and to find the prefix shingles. A place goes on to the join with as many words around it as a window has, so texts
    aren't moved. The join on the shingle's hash is followed by the positional and length bounds (the window must begin and end inside the document)
    and by comparing the words.
    """
    wins = staged(windows(benchmark, window, item_id, text), "windows")
    words = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(F.col(f"`{text}`")).alias("t"), plain_words(F.col(f"`{text}`")).alias("words"))
    n_words = F.size("words").cast("long").alias("n_words")
    prefixes = staged(rarest_shingles(words, wins), "prefixes")
    bitmap = _Bitmap(prefixes.select("hash", "length").distinct())

    def place(i: Column, n: int) -> Column:
        first = F.greatest(i - (window - 1), F.lit(0))
        return F.struct(_hash(F.col("words"), i, n).alias("hash"), i.alias("i"), first.alias("first"), F.slice("words", first + 1, i - first + window).alias("around"))

    found = staged(words.select("doc_id", "t", n_words, bitmap.places(F.col("words"), place).alias("places")), "places")
    places = found.select("doc_id", "t", "n_words", F.explode("places").alias("p")).select("doc_id", "t", "n_words", "p.*")
    start, n = F.col("i") - F.col("at"), F.size("words")
    inside = (start >= 0) & (start + n <= F.col("n_words"))
    same = F.slice("around", F.when(inside, start - F.col("first") + 1).otherwise(F.lit(1)), n) == F.col("words")
    hits = places.join(prefixes, "hash").filter(inside & same).select("doc_id", "t", "item_id", start.alias("start"), n.alias("n"))
    return found.select("doc_id", "t", "n_words"), hits


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id") -> DataFrame:
    """One row per row of `docs`: doc_id, t, n_words, n_hit (words inside an occurrence of a window), items (ids as text, sorted), contaminated.

    Null and wordless texts have no words and are clean. Rows alike in id and text get alike results. An item without an id makes hits but isn't listed;
    items that share an id count once. Other columns are ignored, whatever their names.
    """
    found, hits = occurrences(docs, benchmark, window, doc_id, text, item_id)
    hits = staged(hits, "hits")
    covered = hits.select("doc_id", "t", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("n") - 1)).alias("at")).distinct()
    n_hit = covered.groupBy("doc_id", "t").agg(F.count("*").alias("n_hit"))
    items = hits.select("doc_id", "t", F.col("item_id").cast("string").alias("item")).distinct().groupBy("doc_id", "t").agg(F.array_sort(F.collect_list("item")).alias("items"))
    both = n_hit.alias("h").join(items.alias("i"), F.col("h.doc_id").eqNullSafe(F.col("i.doc_id")) & F.col("h.t").eqNullSafe(F.col("i.t")))
    both = both.select(F.col("h.doc_id").alias("hit_id"), F.col("h.t").alias("hit_t"), "n_hit", "items")
    joined = found.join(both, F.col("doc_id").eqNullSafe(F.col("hit_id")) & F.col("t").eqNullSafe(F.col("hit_t")), "left")
    return joined.select("doc_id", "t", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"), F.col("n_hit").isNotNull().alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, window: int = 10, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id") -> DataFrame:
    """The rows of `docs` in which no window of an item occurs, unchanged, whatever their other columns are called.

    Rows without an id, repeated rows and ids that several texts share are told apart by their text. Null and wordless texts are clean, and so is an
    empty table.
    """
    _, hits = occurrences(docs, benchmark, window, doc_id, text, item_id)
    hit_id, hit_t = free_name(docs, "hit_id"), free_name(docs, "hit_t")
    bad = staged(hits.select(F.col("doc_id").alias(hit_id), F.col("t").alias(hit_t)).distinct(), "contaminated")
    return docs.join(bad, F.col(f"`{doc_id}`").eqNullSafe(F.col(hit_id)) & (F.xxhash64(F.col(f"`{text}`")) == F.col(hit_t)), "left_anti")


def digest(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    rows = contamination(docs, benchmark, window)
    return rows.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


#: The same result in DuckDB.
ORACLE = r"""
WITH lowered AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
items AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
starts AS (SELECT item_id, words, unnest(range(1, greatest(len(words) - 8, 2))) AS i FROM items WHERE len(words) > 0),
wins AS (SELECT DISTINCT item_id, array_to_string(words[i:i + 9], ' ') AS w, least(len(words), 10) AS n FROM starts),
places AS (SELECT rid, words, s.n, unnest(range(1, len(words) - s.n + 2)) AS i FROM lowered, (SELECT DISTINCT n FROM wins) s WHERE len(words) >= s.n),
hits AS (SELECT rid, item_id, i, p.n FROM (SELECT rid, i, n, array_to_string(words[i:i + n - 1], ' ') AS w FROM places) p JOIN wins USING (w, n)),
covered AS (SELECT rid, count(DISTINCT spot) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS spot FROM hits) GROUP BY rid),
listed AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item_id::VARCHAR AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM lowered LEFT JOIN covered USING (rid) LEFT JOIN listed USING (rid)
"""
