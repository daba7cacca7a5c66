"""Collocations from word n-gram counts, counted on FM-indexes of shards.

Texts are cut into shards of about ``shard_words`` words, at document ends. A shard numbers its words, lays its pieces end to end with a
separator between them, and keeps two Burrows-Wheeler transforms: of the word sequence and of its reverse, over suffixes sorted to the longest phrase's
depth (enough for intervals of phrases up to that length). A phrase is a pair of intervals of equal size, one in each. Extending it to the
left splits its interval by the symbols of the first transform, to the right by those of the second; ranks give the new interval there, and the
counts of smaller symbols shift the other one. So one step yields all one-word extensions of all phrases of a length, with their counts.

Counts are summed across shards. A phrase can only be frequent if all shorter phrases inside it are, so a shard extends only phrases whose parts the bit
tables of frequent phrases hold, alternately to the left and right, two lengths a pass. Pairs are first counted by shortened keys alone, which gives
a table of all pairs that can be frequent. Between shards and sums go packed runs, one a shard and part of the keys. The tables' size follows the
number of frequent phrases up to ``MOST_BITS``; beyond that they hold back less, and results stay the same.

Words go by 64-bit hashes of (language, word) between shards. The word counts hold every hash against its words: should two words share one,
the index is built anew with another salt.

Scores are exact decimals. No step gathers a language or a frequent word's phrases in one task: the best of each language are first
taken from ``BUCKETS`` parts of its phrases.

Defined results: a null or empty text has no words; a null language is ``und``; words of different languages are never the same; repeated rows and texts count once
a row; an empty table gives an empty result. Columns other than the language and the text are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import on_workers, pin, text_or_empty

#: Byte table: A-Z lower-cased, what ends a piece becomes a line feed, a tab a blank.
_FOLD = bytes(0x0A if c in b".,;:!?\n\x0b\x0c\r" else 0x20 if c == 0x09 else c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
SEPARATOR, NOTHING = 0, -1
MOST_BITS, BUCKETS = 1 << 26, 64
#: Bits of a pair's key, and words of the corpus for each part of the keys (a part is summed in one piece).
KEY_BITS, PART_WORDS = 40, 1 << 21
_TURN = 11


class _Numbers(dict):
    """Word -> its number in the shard, given at the first look-up."""

    def __init__(self, lang: str, names: list):
        super().__init__({b"\n": SEPARATOR, b"": NOTHING})
        self.lang, self.names = lang, names

    def __missing__(self, word: bytes) -> int:
        self.names.append((self.lang, word))
        self[word] = len(self.names)
        return len(self.names)


def words_of(raw: bytes, numbers: _Numbers) -> np.ndarray:
    """Numbers of a text's words, pieces apart."""
    tokens = raw.translate(_FOLD).replace(b"\n", b" \n ").split(b" ")
    found = np.fromiter(map(numbers.__getitem__, tokens), np.int32, len(tokens))
    return found[found != NOTHING]


def _sorted(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ascending keys, their first positions in order): a stable argsort by one sort of whole words, where key and position fit 63 bits."""
    bits = max(1, len(key)).bit_length()
    if len(key) and int(key.max()) >> (63 - bits):
        order = np.argsort(key, kind="stable")
        return key[order], order
    both = np.sort(key << bits | np.arange(len(key)))
    return both >> bits, both & ((1 << bits) - 1)


def transform(seq: np.ndarray, depth: int) -> np.ndarray:
    """Burrows-Wheeler transform of ``seq`` (its last value a separator), over suffixes sorted by their first ``depth`` values."""
    rank, seen = seq.astype(np.int64), 1
    while True:
        step = min(seen, depth - seen)
        if step:
            ahead = np.zeros_like(rank)
            ahead[:-step] = rank[step:]
            rank = rank * (int(rank.max()) + 1) + ahead
        held, order = _sorted(rank)
        seen += step
        if seen == depth or len(seq) < 2:
            return seq[order - 1]
        rank[order] = np.cumsum(np.concatenate([[0], held[1:] != held[:-1]]))


class Index:
    """Both transforms of a shard, ready for extensions."""

    def __init__(self, forward: np.ndarray, backward: np.ndarray):
        self.symbols = int(forward.max()) + 1
        self.counts = np.bincount(forward, minlength=self.symbols)
        self.texts = (forward, backward)
        self.to: list[np.ndarray | None] = [None, None]

    def ranked(self, side: int) -> np.ndarray:
        """Row -> row of the suffix that begins one word earlier."""
        if self.to[side] is None:
            _, order = _sorted(self.texts[side].astype(np.int64))
            self.to[side] = np.empty(len(order), np.int64)
            self.to[side][order] = np.arange(len(order))
        return self.to[side]

    def words(self) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
        """All single words: (phrases, [first row in either index], size)."""
        first = np.cumsum(self.counts) - self.counts
        known = np.arange(1, self.symbols)
        return known[:, None], [first[known], first[known]], self.counts[known]

    def extend(self, state, side: int, wanted: np.ndarray):
        """All extensions by one word of ``wanted`` (a flag a symbol) to the left (side 0) or right (1), with their intervals and counts."""
        phrases, firsts, sizes = state
        own = np.repeat(np.arange(len(sizes)), sizes)
        rows = np.arange(len(own)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + firsts[side][own]
        key = own * self.symbols + self.texts[side][rows]
        key, order = _sorted(key)
        begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        size = np.diff(np.append(begin, len(key)))
        parent, symbol = key[begin] // self.symbols, key[begin] % self.symbols
        before = begin - (np.cumsum(sizes) - sizes)[parent]  # rows of the parent with smaller symbols
        new = [None, None]
        new[side] = self.ranked(side)[rows[order[begin]]]
        new[1 - side] = firsts[1 - side][parent] + before
        keep = wanted[symbol]
        added = symbol[keep][:, None]
        phrases = np.hstack([added, phrases[parent[keep]]] if side == 0 else [phrases[parent[keep]], added])
        return phrases, [x[keep] for x in new], size[keep]


def phrase_key(words: np.ndarray) -> np.ndarray:
    """One 64-bit key a row of word hashes; the same as :func:`key_sql`."""
    out = np.zeros(len(words), np.uint64)
    for i in range(words.shape[1]):
        turn = _TURN * i
        out ^= (words[:, i] << np.uint64(turn)) | (words[:, i] >> np.uint64(64 - turn)) if turn else words[:, i]
    return out


def key_sql(d: int) -> str:
    """:func:`phrase_key` of the array ``ws``."""
    turned = [f"(shiftleft(ws[{i}], {_TURN * i}) | shiftrightunsigned(ws[{i}], {64 - _TURN * i}))" if i else "ws[0]" for i in range(d)]
    return " ^ ".join(turned)


def _bit_table(keys: DataFrame) -> np.ndarray:
    """Bits of all values of ``key``, and of others; at most MOST_BITS."""
    size = min(MOST_BITS, 1 << max(10, (16 * keys.count()).bit_length()))
    words = (keys.select(F.expr(f"pmod(key, {size})").alias("bit")).select(F.expr("bit div 32").alias("w"), F.expr("shiftleft(1L, cast(bit % 32 as int))").alias("b"))
             .groupBy("w").agg(F.bit_or("b").alias("b")).toArrow())  # at most MOST_BITS / 32 rows
    out = np.zeros(size // 32, np.uint32)
    out[words.column("w").to_numpy()] = words.column("b").to_numpy()
    return out


def _held(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys & np.uint64(32 * len(bits) - 1)
    return (bits[(at >> np.uint64(5)).astype(np.int64)] >> (at & np.uint64(31)).astype(np.uint32) & 1).astype(bool)


def _word_hash(lang: str, word: bytes, salt: int) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(lang.encode() + b"\x00" + word, salt)


_INDEX = "shard bigint, forward binary, backward binary, hashes binary, lang string, word string, w1 bigint, n bigint"


def build_index(docs: DataFrame, depth: int, shard_words: int, salt: int) -> DataFrame:
    """One row a shard with its transforms and word hashes, and one row a word of it with its count."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        names, numbers, held, size = [], {}, [], 0

        def shard() -> Iterator[pa.RecordBatch]:
            seq = np.concatenate([np.zeros(1, np.int32), *held])
            hashes = np.array([0] + [_word_hash(lang, word, salt) for lang, word in names], np.uint64)
            pack = zstandard.ZstdCompressor(1).compress
            whole = [transform(seq, depth), transform(seq[::-1], depth)]
            number = (part << 32) + made
            one = [number, *[pack(x.tobytes()) for x in whole], pack(hashes.tobytes()), None, None, None, None]
            yield _record([[x] for x in one])
            counts = np.bincount(seq, minlength=len(names) + 1)[1:]
            for a in range(0, len(names), 1 << 16):
                some = names[a:a + (1 << 16)]
                k = len(some)
                yield _record([[number] * k, *[[None] * k] * 3, [x for x, _ in some], [w.decode("utf-8", "surrogatepass") for _, w in some], hashes[1 + a:1 + a + k].view(np.int64), counts[a:a + k]])

        for batch in batches:
            for lang, raw in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary())):
                if lang not in numbers:
                    numbers[lang] = _Numbers(lang, names)
                held.append(np.append(words_of(raw.as_py(), numbers[lang]), np.int32(SEPARATOR)))
                size += len(held[-1])
                if size >= shard_words:
                    yield from shard()
                    made += 1
                    names, numbers, held, size = [], {}, [], 0
        if held:
            yield from shard()

    return docs.mapInArrow(run, _INDEX)


def _record(columns: list) -> pa.RecordBatch:
    types = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.string(), pa.string(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=[f.split()[0] for f in _INDEX.split(", ")])


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers as compressed byte planes: the empty planes of small ones take no room."""
    return zstandard.ZstdCompressor(1).compress(np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes())


def _unpacked(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(8, -1).T).view("<u8").ravel()


def _shards(index: DataFrame, of_shard, schema: str) -> DataFrame:
    """What ``of_shard(index, hashes)`` gives for every shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                unpack = zstandard.ZstdDecompressor().decompress
                forward, backward = (np.frombuffer(unpack(batch.column(c)[k].as_py()), np.int32) for c in ("forward", "backward"))
                hashes = np.frombuffer(unpack(batch.column("hashes")[k].as_py()), np.uint64)
                yield from of_shard(Index(forward, backward), hashes)

    return index.select("forward", "backward", "hashes").mapInArrow(run, schema)


def _known(index: Index, hashes: np.ndarray, bits: np.ndarray):
    """Flags of the frequent words, and the state of all phrases of one such word."""
    known = _held(bits, hashes)
    known[SEPARATOR] = False
    state = index.words()
    return known, _kept(state, known[state[0][:, 0]])


def likely_pairs(index: DataFrame, words: np.ndarray, parts: int, least: int) -> DataFrame:
    """Keys (``KEY_BITS`` bits of the phrase key) whose pairs of words of the table ``words`` occur at least ``least`` times together; pairs that share a key
    count as one, so no frequent pair is missed. A shard sends its sorted keys as packed differences, a row for each part of the key range."""
    shared, schema = index.sparkSession.sparkContext.broadcast(words), "part bigint, keys binary, counts binary"

    def of_shard(index: Index, hashes: np.ndarray) -> Iterator[pa.RecordBatch]:
        known, state = _known(index, hashes, shared.value)
        phrases, _, sizes = index.extend(state, 0, known)
        keys, order = _sorted((phrase_key(hashes[phrases]) >> np.uint64(64 - KEY_BITS)).astype(np.int64))
        counts, part = sizes[order], keys * parts >> KEY_BITS
        begin = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else np.zeros(0, np.int64)
        rows = [(int(part[a]), _packed(np.diff(keys[a:b], prepend=0)), _packed(counts[a:b])) for a, b in zip(begin, [*begin[1:], len(part)])]
        for a in range(0, len(rows), 256):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[a:a + 256]), (pa.int64(), pa.binary(), pa.binary()))], names=["part", "keys", "counts"])

    def add(key, table):
        keys = np.concatenate([np.cumsum(_unpacked(x.as_py())) for x in table.column("keys")]).astype(np.int64)
        counts = np.concatenate([_unpacked(x.as_py()) for x in table.column("counts")])
        keys, order = _sorted(keys)
        begin = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        return pa.table({"key": pa.array(keys[begin[np.add.reduceat(counts[order], begin) >= least]], pa.int64())})

    return _shards(index, of_shard, schema).groupBy("part").applyInArrow(add, "key bigint")


def count_phrases(index: DataFrame, d: int, longest: int, tables: list[np.ndarray], parts: int, least: int) -> DataFrame:
    """d, ws (word hashes), f of the frequent phrases of d and, up to ``longest``, d + 1 words. ``tables``: bit tables of words, pairs (by their KEY_BITS
    keys) and then of each length below d. A shard extends what the tables hold, and sends its sums as packed columns, a row for each length and part of the phrases."""
    shared = index.sparkSession.sparkContext.broadcast(tables)  # each at most MOST_BITS
    schema = "d int, part bigint, words binary, counts binary"

    def fits(words: np.ndarray) -> np.ndarray:
        """Whether all parts of a phrase that the tables know are held: its runs of the greatest such length."""
        n = min(words.shape[1], len(shared.value))
        keep = np.ones(len(words), bool)
        for a in range(words.shape[1] - n + 1):
            keys = phrase_key(words[:, a:a + n])
            keep &= _held(shared.value[n - 1], keys >> np.uint64(64 - KEY_BITS) if n == 2 else keys)
        return keep

    def of_shard(index: Index, hashes: np.ndarray) -> Iterator[pa.RecordBatch]:
        known, state = _known(index, hashes, shared.value[0])
        for now in range(2, min(d + 1, longest) + 1):
            state = index.extend(state, now % 2, known)  # to the left for pairs, then in turn
            words = hashes[state[0]]
            keep = fits(words)
            state, words = _kept(state, keep), words[keep]
            if now >= d and len(words):
                part = (phrase_key(words) % np.uint64(parts)).astype(np.int64)
                part, order = _sorted(part)
                begin = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
                words, sizes = words[order], state[2][order]
                rows = [(now, int(part[a]), zstandard.ZstdCompressor(1).compress(np.ascontiguousarray(words[a:b]).tobytes()), _packed(sizes[a:b])) for a, b in zip(begin, [*begin[1:], len(part)])]
                for a in range(0, len(rows), 256):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[a:a + 256]), (pa.int32(), pa.int64(), pa.binary(), pa.binary()))], names=["d", "part", "words", "counts"])

    def add(key, table):
        n, unpack = key[0].as_py(), zstandard.ZstdDecompressor().decompress
        words = np.concatenate([np.frombuffer(unpack(x.as_py()), np.uint64).reshape(-1, n) for x in table.column("words")])
        counts = np.concatenate([_unpacked(x.as_py()) for x in table.column("counts")])
        order = np.lexsort(words.T)
        words = words[order]
        begin = np.flatnonzero(np.concatenate([[True], (words[1:] != words[:-1]).any(axis=1)]))
        sums = np.add.reduceat(counts[order], begin).astype(np.int64)
        keep = sums >= least
        words, sums = words[begin[keep]].view(np.int64), sums[keep]
        ws = pa.ListArray.from_arrays(pa.array(np.arange(len(words) + 1) * n, pa.int32()), pa.array(words.ravel()))
        return pa.table({"d": pa.array(np.full(len(words), n, np.int32)), "ws": ws, "f": pa.array(sums)})

    return _shards(index, of_shard, schema).groupBy("d", "part").applyInArrow(add, "d int, ws array<bigint>, f bigint")


def _kept(state, keep: np.ndarray):
    phrases, firsts, sizes = state
    return phrases[keep], [x[keep] for x in firsts], sizes[keep]


def frequent_phrases(docs: DataFrame, longest: int = 5, least: int = 100, shard_words: int = 1 << 20, lang_col: str = "lang", text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(words, phrases, totals): lang, word, w1, f of frequent words; ws (array of word hashes), f of frequent phrases of 1 to ``longest`` words;
    lang, n (all word occurrences). Frequent: at least ``least`` occurrences in the language."""
    on_workers(docs.sparkSession)
    slim = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), text_or_empty(F.col(text_col)).alias("text"))
    for salt in range(8):
        built = pin(build_index(slim, longest, shard_words, salt))
        words = pin(built.where("w1 is not null").groupBy("lang", "word", "w1").agg(F.sum("n").alias("f")))
        # two words of one hash, among all words of the corpus: next salt
        if words.groupBy("w1").count().where("count > 1").isEmpty():
            break
    else:
        raise RuntimeError("word hashes collide under every salt")
    totals = pin(words.groupBy("lang").agg(F.sum("f").alias("n")))
    frequent = pin(words.where(F.col("f") >= least))
    index, all_words = built.where("w1 is null"), totals.agg(F.sum("n")).first()[0] or 0
    parts = max(1, all_words // PART_WORDS)
    out = frequent.select(F.array("w1").alias("ws"), "f")
    tables = [_bit_table(frequent.select(F.col("w1").alias("key")))]
    if longest > 1:
        tables.append(_bit_table(pin(likely_pairs(index, tables[0], parts, least))))
    for d in range(2, longest + 1, 2):
        found = pin(count_phrases(index, d, longest, tables, parts, least))
        out = out.unionByName(found.select("ws", "f"))
        tables += [_bit_table(found.where(F.col("d") == k).select(F.expr(key_sql(k)).alias("key"))) for k in (d, d + 1) if 2 < k < longest]
    return frequent, out, totals


def _exact(c: Column) -> Column:
    return c.cast("decimal(19,0)")


def collocations(docs: DataFrame, longest: int = 5, least: int = 100, top: int = 2000, absorbed_pct: int = 100, shard_words: int = 1 << 20,
                 lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of 2 to ``longest`` words of each language.

    score: floor(1000 a n / (l r)) of the cut where it is lowest (then the earliest). A phrase goes if one word more, before
    or after it, keeps ``absorbed_pct`` per cent of its occurrences; any longer phrase around it that keeps so many has such a part."""
    words, phrases, totals = frequent_phrases(docs, longest, least, shard_words, lang_col, text_col)
    size = F.size("ws")
    longer = phrases.where(size > 2)
    around = (longer.select(F.expr("slice(ws, 1, size(ws) - 1)").alias("p"), "f").unionByName(longer.select(F.expr("slice(ws, 2, size(ws) - 1)").alias("p"), "f"))
              .groupBy("p").agg(F.max("f").alias("kept")))
    around = pin(around)
    several = phrases.where(size > 1).select("ws", F.col("f").alias("a"))
    stay = several.join(around, several["ws"] == around["p"], "left").where(F.expr(f"kept is null or 100 * kept < {absorbed_pct} * a")).select("ws", "a")
    of_lang = words.select(F.col("w1").alias("_w"), "lang")
    stay = stay.join(of_lang, F.col("ws")[0] == F.col("_w")).join(totals, "lang").select("ws", "a", "lang", "n")
    cuts = stay.withColumn("k", F.explode(F.expr("sequence(1, size(ws) - 1)"))).withColumn("p", F.expr("slice(ws, 1, k)")).withColumn("q", F.expr("slice(ws, k + 1, size(ws) - k)"))
    left, right = (phrases.select(F.col("ws").alias(x), F.col("f").alias(y)) for x, y in (("p", "l"), ("q", "r")))
    score = F.expr("(1000BD * a_ * n_) div (l_ * r_)").cast("bigint")
    scored = (cuts.join(left, "p").join(right, "q").withColumns({f"{c}_": _exact(F.col(c)) for c in ("a", "n", "l", "r")}).withColumn("score", score)
              .groupBy("ws", "a", "lang", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")).select("ws", "a", "lang", "n", "cut.score", "cut.l", "cut.r"))
    scored = pin(scored)
    spelled = (scored.select("ws", F.posexplode("ws").alias("i", "_w")).join(words.select(F.col("w1").alias("_w"), "word"), "_w")
               .groupBy("ws").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "word"))), lambda x: x["word"]), " ").alias("phrase")))
    named = scored.join(spelled, "ws").drop("ws")
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = named.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(BUCKETS)))
    some = part.withColumn("_rank", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*best))).where(F.col("_rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("bigint")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
