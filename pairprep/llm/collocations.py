"""Phrases whose words occur together more often than apart, counted by broadcast double-array tries.

Candidates grow level by level, and no frequent phrase can be missed: phrases of k words are counted
by a 64-bit hash, and only where both phrases of k - 1 words inside passed; those passes look into a
bitmap that holds all hashes found often enough, so a hash that meets another only lets one candidate
more through; it has BITS bits, and up to MOST_BITS where there are more hashes. Every text has one of
CLASSES classes, and the texts of the smallest class that has a phrase then give its words. These
phrases, with all words in them, go into tries over the numbers of one vocabulary: a double array in
which state s has a child for word w at place base[s] + w where check is s. A trie holds about BLOCK
phrases or BLOCK_BYTES of them; the first two words of a phrase say in which one it is, so tasks build
them side by side, and a text position is looked up in one of them only, however many there are. Tries
of PASS_BYTES are broadcast at a time. Every task moves the states of all its text positions with
numpy, one word further at a time, and counts accepting states; Spark sums the tasks' counts. These
counts are exact and all that scores are made of. Scores, their order and the phrases inside longer
ones are DataFrame expressions.

What a task holds is bounded by CHUNK bytes of text (or one piece, where that is longer), the bitmaps,
PASS_BYTES of tries and their counts, a vocabulary of at most WORDS words (or of one trie's phrases)
and COUNTS hashes, or states a trie, whatever the texts are.

Defined results: a null text is empty and a null language is `und`; texts of separators alone have no
words; repeated rows count each; only text and language columns are read; of equal scores the order
is by count, then phrase; a language without candidates, and an empty table, give no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from xxhash import xxh64_intdigest

from pairprep.sources.scratch import stage

MIN_COUNT = 10
MAX_WORDS = 3
TOP = 2000
INSIDE_PERCENT = 50
UNKNOWN_LANGUAGE = "und"
WORD_ENDS = b" \t"
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
CHUNK = 4_000_000
COUNTS = 2_000_000
BITS = 1 << 27
MOST_BITS = 1 << 28
HASH_BITS = 32  # of a bitmap, for each of its hashes
BITMAP_BITS = 1 << 15  # of one group of Spark's bitmap_construct_agg
SLICES = 8  # in which a bitmap reaches the driver
BLOCK = 1_000_000
BLOCK_BYTES = 64_000_000
WORDS = 4_000_000
PASS_BYTES = 250_000_000
CELL = 1 << 14  # states whose counts go on in one row
MOST_COUNTED = 1 << 30  # words after which a task hands its counts on
SALTS = 64
CLASSES = 1 << 16

_KINDS = bytes(2 if c in PIECE_ENDS else 1 if c in WORD_ENDS else 0 for c in range(256))


@dataclass(frozen=True)
class Words:
    """Words of one language in text order: distinct ones, their numbers, and the pieces they are in."""

    language: str
    distinct: pa.Array
    codes: np.ndarray
    pieces: np.ndarray
    classes: np.ndarray  # of the texts that the words are from

    def together(self, size: int) -> np.ndarray:
        """Whether the size words from each place on are in one piece; size - 1 places less."""
        return self.pieces[: len(self.pieces) - size + 1] == self.pieces[size - 1 :]


def words_in(language: str, data: bytes, classes: np.ndarray | None = None, begins: np.ndarray | None = None) -> Words:
    """The words of texts put together; `begins` says from which byte on each class counts."""
    data = data.lower()  # of bytes: A-Z only
    kinds = np.frombuffer(data.translate(_KINDS), np.uint8)
    edges = np.diff(np.concatenate(([0], (kinds == 0).view(np.int8), [0])))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    offsets = np.concatenate(([0], np.cumsum(ends - starts)))
    letters = data.translate(None, WORD_ENDS + PIECE_ENDS)
    buffers = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(letters)]
    coded = pa.Array.from_buffers(pa.large_binary(), len(starts), buffers).dictionary_encode()
    pieces = np.searchsorted(np.flatnonzero(kinds == 2), starts)
    if classes is None:
        classes, begins = np.zeros(1, np.uint64), np.zeros(1, np.int64)
    words_before = np.append(np.searchsorted(starts, begins), len(starts))
    return Words(language, coded.dictionary, np.asarray(coded.indices), pieces, np.repeat(classes, np.diff(words_before)))


def _cut(data: bytes) -> Iterator[bytes]:
    """Parts of about CHUNK bytes that end where a piece does."""
    at = 0
    while len(data) - at > CHUNK:
        after = np.flatnonzero(np.frombuffer(data[at + CHUNK : at + 2 * CHUNK].translate(_KINDS), np.uint8) == 2)
        if not len(after):  # a very long piece: look on until it ends
            rest = np.frombuffer(data[at + 2 * CHUNK :].translate(_KINDS), np.uint8) == 2
            if not rest.any():
                break
            end = at + 2 * CHUNK + int(rest.argmax()) + 1
        else:
            end = at + CHUNK + int(after[0]) + 1
        yield data[at:end]
        at = end
    yield data[at:]


def words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[Words]:
    """Words of (language, text) batches, texts of a language put together until CHUNK bytes are there."""
    waiting: dict[str, list[bytes]] = {}
    held = 0
    for batch in batches:
        for language, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            data = text.encode()
            waiting.setdefault(language, []).append(data)
            held += len(data)
            if held >= CHUNK:
                yield from _flushed(waiting)
                waiting, held = {}, 0
    yield from _flushed(waiting)


def _flushed(waiting: dict[str, list[bytes]]) -> Iterator[Words]:
    for language, texts in waiting.items():
        classes = np.array([zlib.crc32(t) & (CLASSES - 1) for t in texts], np.uint64)
        begins = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
        at = 0
        for part in _cut(b"\n".join(texts)):  # a line end keeps the texts apart
            inside = slice(max(np.searchsorted(begins, at, "right") - 1, 0), np.searchsorted(begins, at + len(part)))
            words = words_in(language, part, classes[inside], np.maximum(begins[inside] - at, 0))
            at += len(part)
            if len(words.codes):
                yield words


def _joined_hash(left: np.ndarray, word: np.ndarray) -> np.ndarray:
    h = left * np.uint64(0x9E3779B97F4A7C15) + word
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def word_hashes(words: pa.Array, seed: int) -> np.ndarray:
    """A hash of each word, a sum over its bytes and their places."""
    words = words.cast(pa.large_binary())
    ends = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    if not len(words) or ends[-1] == ends[0]:
        return np.full(len(words), seed, np.uint64)
    lengths = np.diff(ends)
    data = np.frombuffer(words.buffers()[2], np.uint8)[ends[0] : ends[-1]].astype(np.uint64)
    starts = ends[:-1] - ends[0]
    data |= (np.arange(len(data)) - np.repeat(starts, lengths)).astype(np.uint64) << np.uint64(8)
    mixed = _joined_hash(np.full(1, seed, np.uint64), data)
    mixed *= np.uint64(0x9FB21C651E98DF25)
    mixed ^= mixed >> np.uint64(32)
    hashes = np.full(len(words), seed, np.uint64)
    full = np.flatnonzero(lengths)  # reduceat takes no empty ranges
    hashes[full] += np.add.reduceat(mixed, starts[full])
    return _joined_hash(hashes, lengths.astype(np.uint64))


def phrase_hashes(words: Words, size: int) -> Iterator[np.ndarray]:
    """Hashes of the phrases of 1, 2, ... size words that start at each place, pieces or not."""
    single = word_hashes(words.distinct, xxh64_intdigest(words.language.encode()))[words.codes]
    hashes = single
    yield hashes
    for extra in range(1, size):
        hashes = _joined_hash(hashes[: max(len(single) - extra, 0)], single[extra:])
        yield hashes


# bitmaps of hashes


def _bit_places(hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Two places of each hash in a bitmap of `size` bits, as in `bitmap_of`."""
    return hashes & np.uint64(size - 1), (hashes >> np.uint64(32)) & np.uint64(size - 1)


def bits_for(n: int) -> int:
    """Bits of a bitmap for n hashes: a power of two, since places are cut out of the hash."""
    return min(max(1 << (max(n, 1) * HASH_BITS - 1).bit_length(), BITS), MOST_BITS)


def bitmap_of(hashes: DataFrame, bits: int = BITS) -> np.ndarray:
    """A bitmap with the bits of every hash set, put together in groups by Spark.

    The driver fetches a partition a job, so the groups, at most bits / 8 bytes, are dealt out to SLICES
    partitions first: else there are as many jobs as shuffle partitions, and it keeps notes on each.
    """
    low, high = F.col("hash"), F.shiftrightunsigned("hash", 32)
    places = [h.bitwiseAND(F.lit(bits - 1).cast("long")) + 1 for h in (low, high)]  # Spark's first bit is 1
    at = hashes.select(F.explode(F.array(*places)).alias("at"))
    groups = at.groupBy(F.bitmap_bucket_number("at").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")
    )
    whole = np.zeros(bits // 8, np.uint8)
    size = BITMAP_BITS // 8
    for row in groups.repartition(SLICES).toLocalIterator():
        whole[(row.part - 1) * size : row.part * size] = np.frombuffer(row.bits, np.uint8)
    return whole


def in_bitmap(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    found = np.ones(len(hashes), bool)
    for places in _bit_places(hashes, 8 * len(bits)):
        found &= (bits[places >> np.uint64(3)] >> (places & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
    return found


def _may_pass(words: Words, size: int, hashes: list[np.ndarray], bits: np.ndarray | None) -> np.ndarray:
    """Places where a phrase of this size lies in one piece and both its longest parts passed."""
    together = words.together(size)
    if bits is None or not len(together):
        return together
    shorter = in_bitmap(bits, hashes[size - 2])
    return together & shorter[: len(together)] & shorter[1 : len(together) + 1]


def _combined(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct hashes, the sums of their counts, their smallest classes."""
    keys, counts, classes = (np.concatenate(c) for c in zip(*parts))
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate((np.ones(min(len(keys), 1), bool), keys[1:] != keys[:-1])))
    if not len(first):
        return keys, counts, classes
    return keys[first], np.add.reduceat(counts[order], first), np.minimum.reduceat(classes[order], first)


def count_hashes(texts: DataFrame, size: int, bits: np.ndarray | None) -> DataFrame:
    """(hash, n, owner) over all texts, of the phrases of this size whose parts passed; owner is the
    smallest class of a text that has the phrase. Rows with a lang and no hash count all its words."""
    shared = texts.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, ...]] = []
        held = 0
        totals: dict[str, int] = {}
        for words in words_of(batches):
            totals[words.language] = totals.get(words.language, 0) + len(words.codes)
            hashes = list(phrase_hashes(words, size))
            wanted = np.flatnonzero(_may_pass(words, size, hashes, shared.value))
            parts.append(_combined([(hashes[-1][wanted], np.ones(len(wanted), np.int64), words.classes[wanted])]))
            held += len(parts[-1][0])
            if held > COUNTS:
                parts = [_combined(parts)]
                held = len(parts[0][0])
                if held > COUNTS // 2:
                    yield rows(parts[0])
                    parts, held = [], 0
        if parts:
            yield rows(_combined(parts))
        if totals:
            empty = pa.nulls(len(totals), pa.int64())
            arrays = [pa.array(list(totals)), empty, pa.array(list(totals.values())), empty.cast(pa.int32())]
            yield pa.RecordBatch.from_arrays(arrays, ["lang", "hash", "n", "owner"])

    def rows(found: tuple[np.ndarray, ...]) -> pa.RecordBatch:
        keys, counts, classes = found
        arrays = [pa.nulls(len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(counts)]
        return pa.RecordBatch.from_arrays([*arrays, pa.array(classes.astype(np.int32))], ["lang", "hash", "n", "owner"])

    counted = texts.mapInArrow(run, "lang string, hash long, n long, owner int")
    return counted.groupBy("lang", "hash").agg(F.sum("n").alias("n"), F.min("owner").alias("owner"))


def owned(hashes: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """A hash together with a class, as in `owned_hashes`."""
    return hashes ^ (classes << np.uint64(8)) ^ (classes << np.uint64(40))


def owned_hashes(counted: DataFrame) -> DataFrame:
    owner = F.col("owner").cast("long")
    mark = F.shiftleft(owner, 8).bitwiseXOR(F.shiftleft(owner, 40))
    return counted.select(F.col("hash").bitwiseXOR(mark).alias("hash"))


def _phrases(words: Words, size: int, places: np.ndarray) -> pa.Array:
    parts = [words.distinct.take(pa.array(words.codes[places + i])) for i in range(size)]
    return pc.binary_join_element_wise(*parts, pa.scalar(b" ", parts[0].type)).cast(pa.binary()).cast(pa.string())


def phrases_behind(texts: DataFrame, bitmaps: dict[int, tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """Distinct (lang, phrase) behind the hashes: a phrase is given by texts of its owner's class
    alone, whose `owned` hash is in the second bitmap of its size. About one text in CLASSES is of a
    class, so a phrase comes once or a few times, however many texts have it. Its hash is in the first
    one: all places of all texts are looked up, and few but rare phrases meet the bits of others in both."""
    shared = texts.sparkSession.sparkContext.broadcast(bitmaps)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words in words_of(batches):
            hashes = list(phrase_hashes(words, max(shared.value)))
            for size, (often, of_owners) in shared.value.items():
                of_size = hashes[size - 1]
                places = np.flatnonzero(words.together(size))
                for bits, marked in ((often, of_size), (of_owners, owned(of_size, words.classes[: len(of_size)]))):
                    places = places[in_bitmap(bits, marked[places])]
                _, first = np.unique(of_size[places], return_index=True)
                found = _phrases(words, size, places[first])
                names = pa.array([words.language] * len(found), pa.string())
                yield pa.RecordBatch.from_arrays([names, found], ["lang", "phrase"])

    return texts.mapInArrow(run, "lang string, phrase string").distinct()


# tries


@dataclass(frozen=True)
class Vocabulary:
    """Words of all languages and their numbers, in the order of their hashes, no two of which are the same."""

    languages: list[str]
    seed: int
    hashes: np.ndarray
    numbers: np.ndarray
    language: np.ndarray
    words: pa.Array

    def __len__(self) -> int:
        return len(self.hashes)

    def numbers_of(self, language: str, words: pa.Array) -> np.ndarray:
        """The numbers of words; one more than there are for a word that is not here."""
        found = np.full(len(words), len(self), np.int64)
        if language not in self.languages or not len(self):
            return found
        hashes = word_hashes(words, self.seed + self.languages.index(language))
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self) - 1)
        maybe = np.flatnonzero((self.hashes[at] == hashes) & (self.language[at] == self.languages.index(language)))
        same = pc.equal(self.words.take(pa.array(at[maybe])), words.take(pa.array(maybe)).cast(pa.large_binary()))
        known = maybe[np.asarray(same)]
        found[known] = self.numbers[at[known]]
        return found


def _apart(groups: np.ndarray, n: int) -> list[np.ndarray]:
    """The places in each of n groups."""
    order = np.argsort(groups, kind="stable")
    return np.split(order, np.searchsorted(groups[order], np.arange(1, n)))


def vocabulary_of(languages: pa.Array, words: pa.Array, follows: np.ndarray) -> Vocabulary:
    """Distinct words with their languages. They get their numbers by language, then by how many phrases
    they continue, so that children lie close together."""
    languages = languages.dictionary_encode()
    names, of_word = languages.dictionary.to_pylist(), np.asarray(languages.indices, dtype=np.int32)
    numbers = np.empty(len(words), np.int32)
    numbers[np.lexsort((-follows, of_word))] = np.arange(len(words))
    words = words.cast(pa.large_binary())
    for seed in range(0, 1 << 31, max(len(names), 1)):
        hashes = np.zeros(len(words), np.uint64)
        for i, mine in enumerate(_apart(of_word, len(names))):
            hashes[mine] = word_hashes(words.take(pa.array(mine)), seed + i)
        order = np.argsort(hashes)
        if (np.diff(hashes[order]) != 0).all():
            return Vocabulary(names, seed, hashes[order], numbers[order], of_word[order], words.take(pa.array(order)))


@dataclass(frozen=True)
class Trie:
    """Double array over word numbers; state 0 is the root, and word w alone is state 1 + w."""

    vocabulary: Vocabulary
    base: np.ndarray
    check: np.ndarray


def build_trie(languages: pa.Array, phrases: pa.Array, vocabulary: Vocabulary | None = None) -> tuple[Trie, np.ndarray]:
    """The trie of the phrases and the state that accepts each; the vocabulary is that of the phrases
    where none is given.

    States are placed level by level, those with most children first; one with a single child takes
    any free place.
    """
    languages = pc.cast(languages, pa.string()).dictionary_encode()
    split = pc.split_pattern(pc.cast(phrases, pa.large_binary()), b" ")
    lengths = np.asarray(pc.list_value_length(split))
    firsts = np.concatenate(([0], np.cumsum(lengths)[:-1])) if len(lengths) else lengths
    spoken = split.flatten().dictionary_encode()
    n_languages = max(len(languages.dictionary), 1)
    of_language = np.repeat(np.asarray(languages.indices, dtype=np.int64), lengths)
    keys, numbers = np.unique(np.asarray(spoken.indices, dtype=np.int64) * n_languages + of_language, return_inverse=True)
    words, of_word = spoken.dictionary.take(pa.array(keys // n_languages)), keys % n_languages
    if vocabulary is None:
        follows = np.ones(len(numbers), bool)
        follows[firsts] = False
        continued = np.bincount(numbers[follows], minlength=len(keys))
        vocabulary = vocabulary_of(languages.dictionary.take(pa.array(of_word)), words, continued)
    number_of = np.empty(len(keys), np.int64)
    for language, mine in zip(languages.dictionary.to_pylist(), _apart(of_word, n_languages)):
        number_of[mine] = vocabulary.numbers_of(language, words.take(pa.array(mine)))
    numbers = number_of[numbers]

    n_words = len(vocabulary)
    room = _Places(n_words)
    states = 1 + numbers[firsts]
    for level in range(1, int(lengths.max(initial=1))):
        longer = np.flatnonzero(lengths > level)
        # A child is one of its parent for one word, whichever phrases go through it.
        pairs, back = np.unique(states[longer] * (n_words + 1) + numbers[firsts[longer] + level], return_inverse=True)
        states[longer] = room.children(pairs // (n_words + 1), pairs % (n_words + 1))[back]
    return Trie(vocabulary, *room.arrays()), states


class _Places:
    """The two arrays while states are being placed."""

    TRIES = 128
    AT_ONCE = 8  # words of a family that are looked at together

    def __init__(self, n_words: int):
        self.n_words = n_words
        self.end = n_words + 1  # places up to here may be taken
        size = 2 * (n_words + 1) + 1
        self.base = np.zeros(size, np.int32)
        self.check = np.full(size, -1, np.int32)
        self.check[1 : n_words + 1] = 0
        self.chance = np.random.default_rng(0)

    def _grow(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, len(self.check) * 5 // 4) - len(self.check)
            self.base = np.concatenate((self.base, np.zeros(more, np.int32)))
            self.check = np.concatenate((self.check, np.full(more, -1, np.int32)))

    def children(self, parents: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Place the children (sorted by parent, then word) and return their states."""
        firsts = np.flatnonzero(np.concatenate(([True], np.diff(parents) != 0)))
        counts = np.diff(np.append(firsts, len(parents)))
        states = np.empty(len(parents), np.int64)
        for i in np.argsort(-counts, kind="stable"):
            if counts[i] == 1:
                break
            part = slice(firsts[i], firsts[i] + counts[i])
            states[part] = self._put(int(parents[firsts[i]]), words[part])
        alone = firsts[counts == 1]
        free = self._free(len(alone))
        self.base[parents[alone]] = free - words[alone]
        self.check[free] = parents[alone]
        states[alone] = free
        return states

    def _put(self, parent: int, words: np.ndarray) -> np.ndarray:
        least = self.n_words + 1 - int(words[0])
        n = self.TRIES * min(max(len(words) // 8, 1), 32)
        fits = np.sort(self.chance.integers(least, max(self.end - int(words[0]), least) + 1, n))
        self._grow(int(fits[-1]) + int(words[-1]) + 1)
        for i in range(0, len(words), self.AT_ONCE):
            fits = fits[(self.check[fits[:, None] + words[None, i : i + self.AT_ONCE]] == -1).all(axis=1)]
            if not len(fits):
                break
        base = int(fits[0]) if len(fits) else self.end - int(words[0])
        self._grow(base + int(words[-1]) + 1)
        places = base + words
        self.base[parent], self.check[places] = base, parent
        self.end = max(self.end, int(places[-1]) + 1)
        return places

    def _free(self, n: int) -> np.ndarray:
        self._grow(self.end + n)
        free = self.n_words + 1 + np.flatnonzero(self.check[self.n_words + 1 :] == -1)[:n]
        if n:
            self.end = max(self.end, int(free[-1]) + 1)
        return free

    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        """With room for every word behind the last base, so that a step needs no bounds. No base is
        negative, since children lie behind all single words."""
        size = max(self.end, int(self.base.max()) + self.n_words + 1)
        self._grow(size)
        return self.base[:size], self.check[:size]


def codes_of(vocabulary: Vocabulary, words: Words) -> np.ndarray:
    """The numbers of the words in text order."""
    return vocabulary.numbers_of(words.language, words.distinct)[words.codes]


def advance(
    trie: Trie, words: Words, size: int, codes: np.ndarray | None = None, places: np.ndarray | None = None
) -> Iterator[np.ndarray]:
    """States that all places, or those given, reach after 1, 2, ... size words; only those that are in
    the trie."""
    codes = codes_of(trie.vocabulary, words) if codes is None else codes
    unknown = len(trie.vocabulary)
    places = np.arange(len(codes)) if places is None else places
    places = places[codes[places] != unknown]
    if not len(places):
        return
    states = 1 + codes[places]
    yield states
    for level in range(1, size):
        ahead = places + level
        on = ahead < len(codes)
        on[on] = (words.pieces[ahead[on]] == words.pieces[places[on]]) & (codes[ahead[on]] != unknown)
        places, states = places[on], states[on]
        following = trie.base[states] + codes[places + level]
        on = trie.check[following] == states
        places, states = places[on], following[on]
        yield states


# A phrase is in the trie that its first two words say.
MARK = 65_599


def block_of(phrase: Column | str, n_blocks: int) -> Column:
    """As in `_places_by_block`."""
    first, second = (F.crc32(F.coalesce(F.get(_words(phrase), F.lit(i)), F.lit("")).cast("binary")) for i in (0, 1))
    return F.pmod(first * MARK + second, F.lit(n_blocks)).cast("int")


def word_marks(vocabulary: Vocabulary) -> np.ndarray:
    """The checksum of each word, by its number; one of no word is behind the last."""
    marks = np.zeros(len(vocabulary) + 1, np.int64)
    marks[vocabulary.numbers] = [zlib.crc32(w) for w in vocabulary.words.to_pylist()]
    return marks


def _places_by_block(codes: np.ndarray, marks: np.ndarray, n_blocks: int) -> list[np.ndarray]:
    """The places of known words, each in the block that has the phrases which begin there."""
    places = np.flatnonzero(codes != len(marks) - 1)
    if n_blocks == 1:
        return [places]
    of_place = marks[codes]
    blocks = ((of_place * MARK + np.append(of_place[1:], 0)) % n_blocks)[places]
    if n_blocks <= 1 << 16:
        blocks = blocks.astype(np.uint16)  # sorted by radix
    return [places[mine] for mine in _apart(blocks, n_blocks)]


def build_tries(phrases: DataFrame, vocabulary: Vocabulary, n_blocks: int) -> DataFrame:
    """(block, lang, phrase, state, base, check): the phrases with the states that accept them, and a row
    with the two arrays for each block; a written table."""
    shared = phrases.sparkSession.sparkContext.broadcast(vocabulary)
    schema = pa.schema([("block", pa.int32()), ("lang", pa.string()), ("phrase", pa.string()), ("state", pa.int32()), ("base", pa.binary()), ("check", pa.binary())])

    def build(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        languages, texts = (rows.column(c).combine_chunks().cast(pa.string()) for c in ("lang", "phrase"))
        trie, states = build_trie(languages, texts, shared.value)
        block = rows.column("block")[0].as_py()
        n = len(states)
        accepting = [pa.array(np.full(n, block, np.int32)), languages, texts, pa.array(states.astype(np.int32)), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())]
        arrays = [[block], [None], [None], [None], [trie.base.tobytes()], [trie.check.tobytes()]]
        return pa.concat_tables([pa.Table.from_arrays(accepting, schema=schema), pa.table(arrays, schema=schema)])

    dealt = phrases.select(block_of("phrase", n_blocks).alias("block"), "lang", "phrase")
    made = dealt.groupBy("block").applyInArrow(
        build, "block int, lang string, phrase string, state int, base binary, check binary"
    )
    return stage(made, "tries")


def count_in_tries(
    texts: DataFrame, vocabulary: Broadcast, tries: dict[int, Broadcast], n_blocks: int, size: int, singles: bool
) -> DataFrame:
    """(block, state, n) of the states that the places of all texts reach in the tries; words alone are
    counted where `singles` says so, in block 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, marks = vocabulary.value
        mine = {block: Trie(known, *arrays.value) for block, arrays in tries.items()}
        n_words = len(known)
        alone = np.zeros(n_words + 1, np.int64)
        counts = {block: np.zeros(len(trie.check) - n_words - 1, np.int32) for block, trie in mine.items()}
        reached: dict[int, list[np.ndarray]] = {block: [] for block in mine}
        held = passed = 0

        def add() -> None:
            for block, parts in reached.items():
                if parts:
                    more = np.bincount(np.concatenate(parts), minlength=len(counts[block]))
                    counts[block] += more.astype(np.int32)
                    parts.clear()

        for words in words_of(batches):
            codes = codes_of(known, words)
            if singles:
                alone += np.bincount(codes, minlength=n_words + 1)
            places = _places_by_block(codes, marks, n_blocks)
            for block, trie in mine.items():
                for level, states in enumerate(advance(trie, words, size, codes, places[block])):
                    if level:
                        reached[block].append((states - n_words - 1).astype(np.int32))
                        held += len(states)
            passed += len(codes)
            if held > COUNTS * len(mine) or passed > MOST_COUNTED:
                add()
                held = 0
            if passed > MOST_COUNTED:
                for block in mine:
                    yield rows(block, n_words + 1, counts[block])
                    counts[block][:] = 0
                passed = 0
        add()
        if singles:
            yield rows(0, 1, alone[:-1])
        for block in mine:
            yield rows(block, n_words + 1, counts[block])

    def rows(block: int, first: int, counts: np.ndarray) -> pa.RecordBatch:
        found = np.flatnonzero(counts)
        states = (first + found).astype(np.int32)
        cells, starts = np.unique(states // CELL, return_index=True)
        ends = pa.array(np.append(starts, len(states)).astype(np.int32))
        of_states = (pa.ListArray.from_arrays(ends, pa.array(a)) for a in (states, counts[found].astype(np.int64)))
        arrays = [pa.array(np.full(len(cells), block, np.int32)), pa.array(cells.astype(np.int32)), *of_states]
        return pa.RecordBatch.from_arrays(arrays, ["block", "cell", "states", "n"])

    return summed(texts.mapInArrow(run, "block int, cell int, states array<int>, n array<long>"))


def summed(counts: DataFrame) -> DataFrame:
    """(block, state, n): the tasks' counts of CELL states at a time, added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, np.zeros(CELL, np.int64)
        for batch in batches:
            keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            states, n = (np.asarray(batch.column(i).values) for i in (2, 3))
            ends = np.asarray(batch.column(2).offsets), np.asarray(batch.column(3).offsets)
            for i, key in enumerate(keys):
                if key != now:
                    if now is not None:
                        yield rows(now, total)
                    now, total = key, np.zeros(CELL, np.int64)
                total[states[ends[0][i] : ends[0][i + 1]] - key[1] * CELL] += n[ends[1][i] : ends[1][i + 1]]
        if now is not None:
            yield rows(now, total)

    def rows(key: tuple[int, int], total: np.ndarray) -> pa.RecordBatch:
        found = np.flatnonzero(total)
        block = pa.array(np.full(len(found), key[0], np.int32))
        states = pa.array((found + key[1] * CELL).astype(np.int32))
        return pa.RecordBatch.from_arrays([block, states, pa.array(total[found])], ["block", "state", "n"])

    dealt = counts.repartition("block", "cell").sortWithinPartitions("block", "cell")
    return dealt.mapInArrow(run, "block int, state int, n long")


def _words_of_phrases(phrases: DataFrame) -> DataFrame:
    """(lang, word, follows): the distinct words and how many phrases they continue."""
    spoken = phrases.select("lang", F.posexplode(_words("phrase")).alias("at", "word"))
    return spoken.groupBy("lang", "word").agg(F.count_if(F.col("at") > 0).alias("follows"))


def _in_passes(tries: DataFrame) -> Iterator[dict[int, Broadcast]]:
    """The arrays of the tries, PASS_BYTES with their counts, or one trie, at a time."""
    context = tries.sparkSession.sparkContext
    taken: dict[int, Broadcast] = {}
    held = 0
    for row in tries.where("base IS NOT NULL").select("block", "base", "check").toLocalIterator():
        more = 3 * len(row.base)  # with 4 bytes for the count of a state
        if taken and held + more > PASS_BYTES:
            yield taken
            taken, held = {}, 0
        taken[row.block] = context.broadcast(tuple(np.frombuffer(a, np.int32) for a in (row.base, row.check)))
        held += more
    if taken:
        yield taken


def count_phrases(texts: DataFrame, phrases: DataFrame, size: int, block: int = BLOCK) -> DataFrame:
    """(lang, phrase, n) over all texts, in as many tries as it takes; a written table.

    The tries have one vocabulary and the texts are read once for PASS_BYTES of them. Only words that are
    too many or too long for that make parts with a vocabulary each, of one trie's phrases."""
    spark = texts.sparkSession
    phrases = stage(phrases, "phrases")
    size_of = phrases.agg(F.count("*").alias("n"), F.sum(F.octet_length("phrase")).alias("octets")).first()
    n_blocks = max(-(-size_of.n // block), -(-(size_of.octets or 0) // BLOCK_BYTES))
    spoken = stage(_words_of_phrases(phrases), "words")
    words = spoken.agg(F.count("*").alias("n"), F.sum(F.octet_length("word")).alias("octets")).first()
    parts = [(phrases, spoken, n_blocks)] if n_blocks else []
    if words.n > WORDS or (words.octets or 0) > BLOCK_BYTES:
        of_part = F.pmod(F.xxhash64("lang", "phrase"), F.lit(n_blocks))
        some = [phrases.where(of_part == number) for number in range(n_blocks)]
        parts = [(mine, _words_of_phrases(mine), 1) for mine in some]
    counted = None
    for mine, spoken, n_blocks in parts:
        table = spoken.toArrow()
        if not table.num_rows:
            continue
        columns = (table.column(c).combine_chunks() for c in ("lang", "word"))
        vocabulary = vocabulary_of(*columns, table.column("follows").to_numpy())
        del table
        shared = spark.sparkContext.broadcast((vocabulary, word_marks(vocabulary)))
        tries = build_tries(mine, vocabulary, n_blocks)
        # A word alone has the same state in all tries, and is counted under the first block.
        last_word = len(vocabulary)
        del vocabulary
        at = F.when(F.col("state") <= last_word, 0).otherwise(F.col("block")).alias("block")
        accepting = tries.where("state IS NOT NULL").select("lang", "phrase", at, "state")
        found = None
        for taken in _in_passes(tries):
            part = stage(count_in_tries(texts, shared, taken, n_blocks, size, found is None), "phrase-counts")
            found = part if found is None else found.unionByName(part)
            for arrays in taken.values():
                arrays.unpersist()
        named = accepting.join(found, ["block", "state"]).select("lang", "phrase", "n")
        counted = named if counted is None else counted.unionByName(named)
    if counted is None:
        return spark.createDataFrame([], "lang string, phrase string, n long")
    return stage(counted, "counted-phrases")


# scores


def _words(phrase: Column | str) -> Column:
    return F.split(phrase, " ", -1)


def _slice(words: Column, start: Column | int, size: Column | int) -> Column:
    return F.array_join(F.slice(words, start, size), " ")


def scored(counts: DataFrame, min_count: int) -> DataFrame:
    """(lang, phrase, a, l, r, score, size) of the candidates, by their lowest-scoring cut."""
    candidates = counts.select("lang", "phrase", F.col("n").alias("a"), F.size(_words("phrase")).alias("size")).where(
        (F.col("size") > 1) & (F.col("a") >= min_count)
    )
    cut = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    words = _words("phrase")
    sides = cut.withColumns(
        {"left": _slice(words, F.lit(1), F.col("k")), "right": _slice(words, F.col("k") + 1, F.col("size") - F.col("k"))}
    )
    for side, name in (("left", "l"), ("right", "r")):
        sides = sides.join(counts.select("lang", F.col("phrase").alias(side), F.col("n").alias(name)), ["lang", side])
    whole = lambda c: F.col(c).cast("decimal(19,0)")
    score = F.call_function("div", whole("a") * whole("a") * F.lit(1_000_000), whole("l") * whole("r"))
    best = sides.withColumn("score", score).groupBy("lang", "phrase", "a", "size").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut")
    )
    return best.select("lang", "phrase", "a", "size", "cut.l", "cut.r", "cut.score")


def without_parts(candidates: DataFrame, inside_percent: int) -> DataFrame:
    """Candidates but those inside a longer one that has inside_percent of their count."""
    words = _words("phrase")
    longer = candidates.where("size > 2").select("lang", "a", "size", words.alias("words"))
    sized = longer.select("lang", "a", "size", "words", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("part"))
    placed = sized.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("part") + 1)).alias("at"))
    inner = placed.select("lang", "a", _slice(F.col("words"), F.col("at"), F.col("part")).alias("phrase"))
    most = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longest"))
    covered = 100 * F.col("longest") >= inside_percent * F.col("a")
    return candidates.join(most, ["lang", "phrase"], "left").where(~F.coalesce(covered, F.lit(False))).drop("longest")


def first_of_each(rows: DataFrame, top: int) -> DataFrame:
    """The first rows of each language with their rank; a language is cut down in SALTS parts first."""
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    near = Window.partitionBy("lang", "salt").orderBy(*order)
    few = salted.withColumn("rank", F.row_number().over(near)).where(F.col("rank") <= top).drop("salt", "rank")
    return few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)


def collocations(
    docs: DataFrame,
    text: str = "text",
    language: str = "lang",
    min_count: int = MIN_COUNT,
    max_words: int = MAX_WORDS,
    top: int = TOP,
    inside_percent: int = INSIDE_PERCENT,
    block: int = BLOCK,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of 2 to max_words words by language.

    a, l and r count the phrase and the two parts of the cut with the lowest score, n all words of the
    language; score is floor(1000000 a a / (l r)).
    """
    texts = docs.select(
        F.coalesce(F.col(language), F.lit(UNKNOWN_LANGUAGE)).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    bits, bitmaps, totals = None, {}, None
    for size in range(1, max_words + 1):
        often = count_hashes(texts, size, bits).where(F.col("lang").isNotNull() | (F.col("n") >= min_count))
        often = stage(often, "phrase-hashes")
        totals = totals or often.where("hash IS NULL").select("lang", F.col("n").alias("_n"))
        often = often.where("hash IS NOT NULL")
        n_bits = bits_for(often.count())
        bits = bitmap_of(often, n_bits)
        if size > 1:
            bitmaps[size] = (bits, bitmap_of(owned_hashes(often), n_bits))
    found = phrases_behind(texts, bitmaps)
    single = F.explode(F.array_append(_words("phrase"), F.col("phrase"))).alias("phrase")
    counts = count_phrases(texts, found.select("lang", single).distinct(), max_words, block)
    candidates = stage(scored(counts, min_count), "scored")
    ranked = first_of_each(without_parts(candidates, inside_percent), top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("_n").alias("n"), "score"
    )


def op11_collocations(spark, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet").select("text", "lang"))


OP11_SQL = r"""
WITH w AS (
  SELECT r, p, lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM (
    SELECT r, lang, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS p FROM (
      SELECT row_number() OVER () AS r, coalesce(lang, 'und') AS lang, regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]') AS pieces FROM documents))
), f AS (
  SELECT lang, size, ws[i : i + size - 1] AS words, CAST(count(*) AS HUGEINT) AS n FROM (
    SELECT lang, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM w, (VALUES (1), (2), (3)) s(size)
    WHERE len(ws) >= size)
  GROUP BY ALL
), total AS (SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang
), c AS (SELECT lang, size, words, n AS a FROM f WHERE size > 1 AND n >= 10
), cuts AS (
  SELECT c.lang, c.words, c.size, a, k, x.n AS l, y.n AS r, (1000000 * a * a) // (x.n * y.n) AS score
  FROM c JOIN (VALUES (1), (2)) s(k) ON k < c.size
  JOIN f x ON x.lang = c.lang AND x.words = c.words[1 : k]
  JOIN f y ON y.lang = c.lang AND y.words = c.words[k + 1 : c.size]
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1
), covered AS (
  SELECT lang, words, max(a) AS longest FROM (
    SELECT lang, words[1 : 2] AS words, a FROM c WHERE size = 3
    UNION ALL SELECT lang, words[2 : 3], a FROM c WHERE size = 3)
  GROUP BY ALL
), kept AS (
  SELECT b.*, array_to_string(b.words, ' ') AS phrase FROM best b LEFT JOIN covered v ON v.lang = b.lang AND v.words = b.words
  WHERE NOT coalesce(100 * longest >= 50 * a, false)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT ranked.lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
  total.n AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN total ON total.lang = ranked.lang WHERE rank <= 2000
"""
