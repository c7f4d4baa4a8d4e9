"""Phrase collocations of each language, by best-first branch and bound.

A phrase of two or three words is a candidate if it occurs min_count times. It is scored at its weakest
cut, 10^6 a^2 / (l r) with the counts of the whole and of both parts, and dropped if a longer candidate
accounts for half of it. The `top` best phrases of each language are wanted, ties at the end settled.

Growth. Level one counts words, level two pairs of frequent words. Pairs are then the frontier: a pair
(x, y) bounds what can grow from it, because every phrase (x, y, z) scores at most 10^6 f(xy)/f(x) at
its first cut, and every phrase (w, x, y) at most 10^6 f(xy)/f(y) at its last; a pair's own score is not
above either bound. So the frontier is expanded best first: with a threshold per language, just below
the pairs that rank best, only those phrases of three words are counted whose both bounds reach it, or
that a pair scoring that high stands in (they tell whether it is dropped). All surviving phrases that
reach the threshold are then known. A language with `top` of them is settled, ties included; for the
others the threshold falls, to four times as many pairs, until nothing is left to expand.

How it is counted. Words have 64-bit names, made of language and word, so that pairs and triples are
rows of numbers. That no two frequent words share a name is checked on the counts of all words; if two
do, another seed is taken. Which words and pairs are worth counting is told by bit filters of a
fixed size, 4 MB for any corpus: a filter that is too full lets more be counted, and changes no result.
Every task combines equal phrases of some megabytes of text before Spark sums them up by phrase. Nothing
is brought together by language but histograms of scores and, per task, the best `top` phrases.

Defined cases: A-Z are lower-cased; pieces end at . , ; : ! ? and at line ends, words at blanks and tabs.
A null text is empty, a null language is `und`, repeated rows count again, empty tables give an empty
result, other columns don't matter. Words and texts may have any length.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallystone.llm.common import lean, mix, packed, read, stage, text_of
from tallystone.llm.words import named

TOP, MIN_COUNT, SHARE, SCALE = 2000, 10, 50, 1_000_000
LINE, BLANK = 0x0A, 0x20
#: A-Z become a-z, what ends a piece a line end, a tab a blank.
TABLE = bytes(
    b + 32 if 65 <= b < 91 else LINE if chr(b) in ".,;:!?\n\x0b\x0c\r" else BLANK if b in (9, 32) else b for b in range(256)
)
#: Texts are put together up to this size, by language, before their phrases are combined.
BUFFER, ALL_BUFFERS = 8 << 20, 16 << 20
#: A filter has 2^23 places of four bits.
SLOT_BITS = 23
FREQUENT, WORTH, LEADS, ENDS = 1, 2, 4, 8
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)
MAX_SEEDS = 8


def _buffers(batches):
    """(language, text) of some megabytes; the texts of a buffer are ended by line ends."""
    pending: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    for batch in batches:
        row = batch.column(0)
        langs = row.field(row.type.get_field_index("lang")).to_pylist()
        for lang, text in zip(langs, text_of(row), strict=True):
            if not text:
                continue
            pending.setdefault(lang, []).append(text.translate(TABLE))
            sizes[lang] = sizes.get(lang, 0) + len(text)
            while sizes and (sizes[lang] >= BUFFER or sum(sizes.values()) >= ALL_BUFFERS):
                largest = max(sizes, key=sizes.get)
                del sizes[largest]
                yield largest, bytes([LINE]).join(pending.pop(largest))
                if largest == lang:
                    break
    for lang, texts in pending.items():
        yield lang, bytes([LINE]).join(texts)


def _rows(names: list[str], *columns):
    """Record batches of a bounded size."""
    import pyarrow as pa

    arrays = [pa.array(c.view(np.int64)) if isinstance(c, np.ndarray) else c for c in columns]
    whole = pa.RecordBatch.from_arrays(arrays, names=names)
    for at in range(0, whole.num_rows, 200_000):
        yield whole.slice(at, 200_000)


def _word_counts(docs: DataFrame, seed: int, min_count: int) -> DataFrame:
    """(name, lang, f, word, clash): words that occur often enough; with no name, all of a language."""

    def run(batches):
        import pyarrow as pa

        for lang, flat in _buffers(batches):
            names, _, starts, ends = named(flat, LINE, BLANK, seed, lang.encode())
            if not len(names):
                continue
            found, first, counts = np.unique(names, return_index=True, return_counts=True)
            words = pa.array([flat[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)], pa.binary()).cast(pa.string())
            yield from _rows(["name", "lang", "word", "n"], found, pa.array([lang] * len(found), pa.string()), words, counts)
            yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([lang]), pa.array([None], pa.string()), pa.array([len(names)], pa.int64())], names=["name", "lang", "word", "n"])

    found = packed(docs).mapInArrow(lean(run), "name long, lang string, word string, n long")
    summed = found.groupBy("name", "lang").agg(F.sum("n").alias("f"), F.min("word").alias("word"), F.max("word").alias("other"))
    clash = F.coalesce(F.col("word") != F.col("other"), F.lit(False))
    summed = summed.select("name", "lang", "f", "word", clash.alias("clash"))
    return stage(summed.where(F.col("name").isNull() | F.col("clash") | (F.col("f") >= min_count)), "phrase-words")


def _counted_words(docs: DataFrame, min_count: int) -> tuple[DataFrame, int]:
    """The counts of words, under a seed that gives no two of them one name, and the seed."""
    for seed in range(MAX_SEEDS):
        words = _word_counts(docs, seed, min_count)
        twice = words.where("name is not null").groupBy("name").agg(F.count("*").alias("n"), F.max("clash").alias("clash"))
        if twice.where("n > 1 or clash").limit(1).count() == 0:
            return words, seed
    raise RuntimeError(f"words share names under {MAX_SEEDS} seeds")


def _pair_keys(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(x * _STEP + y)


def _filter(marked: DataFrame) -> np.ndarray:
    """Flags by place, for rows (x, y, flags); y is null for words. At most 2^19 rows reach the driver."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            x, flags = batch.column(0).to_numpy().view(np.uint64), batch.column(2).to_numpy().astype(np.uint64)
            keys = x if batch.column(1).null_count else _pair_keys(x, batch.column(1).to_numpy().view(np.uint64))
            slots = keys >> np.uint64(64 - SLOT_BITS)
            bits = flags << (np.uint64(4) * (slots & np.uint64(15)))
            yield pa.RecordBatch.from_arrays([pa.array((slots >> np.uint64(4)).astype(np.int32)), pa.array(bits.view(np.int64))], names=["place", "bits"])

    packed_bits = marked.mapInArrow(lean(run), "place int, bits long").groupBy("place").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << (SLOT_BITS - 4), np.uint64)
    out[packed_bits.column(0).to_numpy()] = packed_bits.column(1).to_numpy().view(np.uint64)
    return out


def _flags(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    slots = keys >> np.uint64(64 - SLOT_BITS)
    return (table[slots >> np.uint64(4)] >> (np.uint64(4) * (slots & np.uint64(15)))) & np.uint64(15)


def _pair_counts(docs: DataFrame, words: DataFrame, seed: int, min_count: int) -> DataFrame:
    """(x, y, f): pairs of frequent words that occur often enough."""
    marked = words.where("name is not null").select(F.col("name").alias("x"), F.lit(None).cast("long").alias("y"), F.lit(FREQUENT).alias("flags"))
    shared = docs.sparkSession.sparkContext.broadcast(_filter(marked))

    def run(batches):
        table = shared.value
        for lang, flat in _buffers(batches):
            names, lines, _, _ = named(flat, LINE, BLANK, seed, lang.encode())
            if len(names) < 2:
                continue
            often = _flags(table, names) > 0
            at = np.flatnonzero((lines[1:] == lines[:-1]) & often[1:] & often[:-1])
            found, place = np.unique(names, return_inverse=True)
            codes, counts = np.unique(place[at] * len(found) + place[at + 1], return_counts=True)
            yield from _rows(["x", "y", "n"], found[codes // len(found)], found[codes % len(found)], counts)

    pairs = packed(docs).mapInArrow(lean(run), "x long, y long, n long").groupBy("x", "y").agg(F.sum("n").alias("f"))
    out = stage(pairs.where(F.col("f") >= min_count), "phrase-pairs")
    shared.destroy()
    return out


def _triple_counts(docs: DataFrame, pairs: DataFrame, seed: int, min_count: int) -> DataFrame:
    """(x, y, z, f): triples whose pairs are marked as worth it."""
    shared = docs.sparkSession.sparkContext.broadcast(_filter(pairs.select("x", "y", "flags")))

    def run(batches):
        table = shared.value
        for lang, flat in _buffers(batches):
            names, lines, _, _ = named(flat, LINE, BLANK, seed, lang.encode())
            if len(names) < 3:
                continue
            flags = np.where(lines[1:] == lines[:-1], _flags(table, _pair_keys(names[:-1], names[1:])), np.uint64(0))
            one, two = flags[:-1], flags[1:]
            grown = ((one & np.uint64(LEADS)) > 0) & ((two & np.uint64(ENDS)) > 0)
            at = np.flatnonzero((one > 0) & (two > 0) & (grown | (((one | two) & np.uint64(WORTH)) > 0)))
            if not len(at):
                continue
            # Words, then pairs, then triples as numbers of this buffer, so that they are told apart exactly.
            found, place = np.unique(np.concatenate([names[at], names[at + 1], names[at + 2]]), return_inverse=True)
            x, y, z = np.split(place, 3)
            pair, inner = np.unique(x * len(found) + y, return_inverse=True)
            codes, counts = np.unique(inner * len(found) + z, return_counts=True)
            first = pair[codes // len(found)]
            yield from _rows(["x", "y", "z", "n"], found[first // len(found)], found[first % len(found)], found[codes % len(found)], counts)

    triples = packed(docs).mapInArrow(lean(run), "x long, y long, z long, n long").groupBy("x", "y", "z").agg(F.sum("n").alias("f"))
    out = stage(triples.where(F.col("f") >= min_count), "phrase-triples")
    shared.destroy()
    return out


def _share(a: str, left: str, right: str):
    """floor(10^6 a^2 / (l r)), exactly: decimals of 38 digits hold counts up to 10^14."""
    return F.expr(f"({SCALE} * cast({a} as decimal(14,0)) * cast({a} as decimal(14,0))) div (cast({left} as decimal(14,0)) * cast({right} as decimal(14,0)))")


def _scored_pairs(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """(x, y, f, lang, fx, fy, score, lead, end): lead and end bound what grows to the right and left."""
    of = words.where("name is not null")
    both = pairs.join(of.select(F.col("name").alias("x"), "lang", F.col("f").alias("fx")), "x")
    both = both.join(of.select(F.col("name").alias("y"), F.col("f").alias("fy")), "y")
    return stage(
        both.select("x", "y", "f", "lang", "fx", "fy", _share("f", "fx", "fy").alias("score"), _share("f", "fx", "f").alias("lead"), _share("f", "fy", "f").alias("end")),
        "phrase-scored",
    )


def _thresholds(pairs: DataFrame, wanted: int) -> DataFrame:
    """(lang, threshold): a score that `wanted` pairs reach, from a histogram; 0 if there are fewer."""
    bucket = F.floor(16 * F.log2(F.col("score") + 1)).alias("bucket")
    counts = pairs.groupBy("lang", bucket).agg(F.count("*").alias("n"), F.min("score").alias("least"))
    above = F.sum("n").over(Window.partitionBy("lang").orderBy(F.desc("bucket")))
    reached = F.max(F.when(F.col("above") >= wanted, F.col("least")))
    return counts.withColumn("above", above).groupBy("lang").agg(F.coalesce(reached, F.lit(0)).alias("threshold"))


def _survivors(pairs: DataFrame, triples: DataFrame, share: int) -> DataFrame:
    """(lang, x, y, z, a, l, r, score) of the phrases that reach the threshold and are not dropped."""
    known = pairs.select("x", "y", "f", "fx", "fy", "lang", "threshold")
    left = known.select("x", "y", F.col("f").alias("fxy"), "fx", "lang", "threshold")
    right = known.select(F.col("x").alias("y"), F.col("y").alias("z"), F.col("f").alias("fyz"), F.col("fy").alias("fz"))
    three = triples.join(left, ["x", "y"]).join(right, ["y", "z"])
    three = three.withColumn("one", _share("f", "fx", "fyz")).withColumn("two", _share("f", "fxy", "fz"))
    first = F.col("one") <= F.col("two")
    three = three.select(
        "lang", "x", "y", "z", F.col("f").alias("a"),
        F.when(first, F.col("fx")).otherwise(F.col("fxy")).alias("l"),
        F.when(first, F.col("fyz")).otherwise(F.col("fz")).alias("r"),
        F.least("one", "two").alias("score"), "threshold",
    )
    inside = triples.select("x", "y", "f").unionAll(triples.select(F.col("y").alias("x"), F.col("z").alias("y"), "f"))
    longer = inside.groupBy("x", "y").agg(F.max("f").alias("longer"))
    two = pairs.where(F.col("score") >= F.col("threshold")).join(longer, ["x", "y"], "left")
    two = two.where(100 * F.coalesce("longer", F.lit(0)) < share * F.col("f"))
    two = two.select("lang", "x", "y", F.lit(None).cast("long").alias("z"), F.col("f").alias("a"), F.col("fx").alias("l"), F.col("fy").alias("r"), "score")
    return two.unionAll(three.where(F.col("score") >= F.col("threshold")).drop("threshold"))


def collocations(docs: DataFrame, text_column: str = "text", lang_column: str = "lang", top: int = TOP, min_count: int = MIN_COUNT, share: int = SHARE) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of each language, best first."""
    docs = docs.select(F.col(f"`{text_column}`").alias("text"), F.coalesce(F.col(f"`{lang_column}`").cast("string"), F.lit("und")).alias("lang"))
    words, seed = _counted_words(docs, min_count)
    left = _scored_pairs(_pair_counts(docs, words, seed, min_count), words)
    wanted, settled = 2 * top, None
    while left.limit(1).count():
        limits = stage(_thresholds(left, wanted), "phrase-limits")
        at = F.col("threshold")
        pairs = left.join(limits, "lang")
        flags = F.lit(FREQUENT) + F.when(F.col("score") >= at, WORTH).otherwise(0) + F.when(F.col("lead") >= at, LEADS).otherwise(0) + F.when(F.col("end") >= at, ENDS).otherwise(0)
        pairs = pairs.withColumn("flags", flags)
        found = stage(_survivors(pairs, _triple_counts(docs, pairs, seed, min_count), share), "phrase-survivors")
        enough = found.groupBy("lang").agg(F.count("*").alias("n")).join(limits, "lang", "right").where((F.col("n") >= top) | (at == 0))
        enough = stage(enough.select("lang"), "phrase-settled")
        mine = found.join(enough, "lang", "left_semi")
        settled = mine if settled is None else settled.unionAll(mine)
        left = stage(left.join(enough, "lang", "left_anti"), "phrase-left")
        wanted *= 4
    totals = words.where("name is null").select("lang", F.col("f").alias("n"))
    if settled is None:
        settled = _survivors(left.withColumn("threshold", F.lit(0)), left.limit(0).select("x", "y", F.col("x").alias("z"), "f"), share)
    spelled = settled
    for name in ("x", "y", "z"):
        of = words.where("name is not null").select(F.col("name").alias(name), F.col("word").alias(f"{name}_word"))
        spelled = spelled.join(of, name, "left" if name == "z" else "inner")
    spelled = spelled.withColumn("phrase", F.concat_ws(" ", "x_word", "y_word", "z_word"))
    place = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = spelled.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read(spark, sf_dir, "documents", "text", "lang"))


OP12_SQL = rf"""
WITH pieces AS (
  SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece
  FROM (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents)),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, greatest(len(w) - k + 2, 1))) AS i FROM words, range(1, 4) AS ks(k))),
f AS (SELECT lang, k, phrase, count(*)::HUGEINT AS f FROM grams GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
often AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= {MIN_COUNT}),
cuts AS (
  SELECT lang, k, phrase, a, w, cut, array_to_string(list_slice(w, 1, cut), ' ') AS p, array_to_string(list_slice(w, cut + 1, k), ' ') AS q
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM often)),
scored AS (
  SELECT c.lang, c.k, c.phrase, c.a, x.f AS l, y.f AS r, ({SCALE} * c.a * c.a) // (x.f * y.f) AS score, cut
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = p AND x.k = cut JOIN f y ON y.lang = c.lang AND y.phrase = q AND y.k = c.k - cut),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, k, phrase ORDER BY score, cut) = 1),
longer AS (
  SELECT lang, phrase, max(a) AS a FROM (
    SELECT lang, array_to_string(list_slice(w, i, i + 1), ' ') AS phrase, a FROM often, range(1, 3) AS s(i) WHERE k = 3) GROUP BY ALL),
kept AS (SELECT s.* FROM weakest s LEFT JOIN longer g ON g.lang = s.lang AND g.phrase = s.phrase AND s.k = 2 WHERE g.a IS NULL OR 100 * g.a < {SHARE} * s.a)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) JOIN n USING (lang)
WHERE rank <= {TOP}
"""
