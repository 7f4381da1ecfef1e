"""Language-model scores from an Elias-Fano trie of n-grams.

The trie has ``order`` levels. Level one holds the distinct training words, by hash, with their probabilities in 16
bits. Each further level holds, for each context, a pointer to its successors, the successors in ascending order and
their probabilities in 8 bits; a context is named by its place in the level above. Contexts, pointers and successors are
non-decreasing numbers and so are stored as Elias-Fano codes, some two bits above the entropy of their gaps. Successors
are found relative to their context: its pointers bound the range, and the number searched there is
the context's place times the number of words plus the successor.

Nothing of the model is in one place. Texts are cut into chunks of about ``CHUNK`` tokens. A
chunk asks a level's shards for its distinct words, then for its distinct pairs of a context and a word, level by level, and gets
an answer for each, so a pair that is everywhere costs a row per chunk. Shards are by hash; a context that
fills more than a piece is spread over several. A shard writes its level to a file, maps it into memory
and answers from there, words as well as pairs; what is decoded at a time is a block of its contexts and their successors.

Chunks and answers are kept in buckets by the task that cut the chunk. A chunk is read with its answers several times, a level
further each time, and no such read shuffles.

Probabilities: p(w) = (c + 0.1) / (N + 0.1 (V + 1)), and p(w | h) = (1 - b) c(h, w) / c(h) + b p(w | h'), h' being h without
its first word. The weight b of contexts as frequent as h (by powers of two) is the share of their pairs
seen once, which estimates how often what follows is new. Unknown contexts have b = 1, and so have contexts of several
words that were seen once, whose only pair was seen once: from level three on they are not asked for.

Null texts are empty and have the end token alone. Null ids count as the empty text for the split;
repeated rows are scored one by one and learned from as often as they occur. With no training documents
every word is unknown. An empty table gives no rows; other columns are ignored.
"""

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from tenderlens.llm.common import bucketed, pick, slices

ORDER = 3
CHUNK = 1_000_000  # tokens
WORDS = 1_000_000  # asked words of a level-one shard
TOKENS = 2_000_000  # tokens of a level-two shard; a context with more is spread
SEED = 42
SAMPLE = 1024  # every so many-th code's place in the upper bits is kept
BLOCK = 1 << 18  # successors decoded at once
LOWEST, STEP = -8.0, 8.0 / 254  # of log10 probabilities in 8 bits; 0 is absent
LOWEST_WORD, STEP_WORD = -20.0, 20.0 / 65534  # of single words, in 16 bits
CLASSES = 48  # of contexts by frequency
PART = 28  # bits of a chunk's number within its task


def pack_bits(values: np.ndarray, width: int) -> bytes:
    parts = []
    for at in range(0, len(values) if width else 0, 1 << 16):
        block = np.ascontiguousarray(values[at : at + (1 << 16)], "<u8").view(np.uint8).reshape(-1, 8)
        parts.append(np.packbits(np.unpackbits(block, axis=1, count=width, bitorder="little"), bitorder="little").tobytes())
    return b"".join(parts)


def unpack_bits(raw: np.ndarray, first: int, many: int, width: int) -> np.ndarray:
    """``many`` numbers from number ``first`` on."""
    out = np.zeros(many, "<u8")
    for at in range(0, many if width else 0, 1 << 16):
        n = min(many - at, 1 << 16)
        bit = (first + at) * width
        bits = np.unpackbits(raw[bit // 8 : (bit + n * width + 7) // 8], bitorder="little")
        bits = bits[bit % 8 : bit % 8 + n * width].reshape(n, width)
        whole = np.zeros((n, 64), np.uint8)
        whole[:, :width] = bits
        out[at : at + n] = np.packbits(whole, axis=1, bitorder="little").view("<u8")[:, 0]
    return out


class EliasFano:
    """Non-decreasing numbers below 2^64: ``low`` bits of each as they are, the rest as gaps in unary."""

    @staticmethod
    def encode(values: np.ndarray) -> bytes:
        many = len(values)
        if not many:
            return np.zeros(4, "<u8").tobytes()
        low = max(0, ((int(values[-1]) + 1) // many).bit_length() - 1)
        ones = (values >> np.uint64(low)).astype(np.int64) + np.arange(many)
        lows = pack_bits(values & np.uint64((1 << low) - 1), low)
        bits = np.zeros(int(ones[-1]) + 1, bool)
        bits[ones] = True
        upper = np.packbits(bits, bitorder="little")
        samples = ones[::SAMPLE].astype("<u8")
        return np.array([many, low, len(lows), len(upper)], "<u8").tobytes() + samples.tobytes() + lows + upper.tobytes()

    def __init__(self, raw: np.ndarray):
        """``raw``: bytes as an array, also a mapped one, that begin with a code."""
        self.many, self.low, lows, upper = (int(v) for v in raw[:32].view("<u8"))
        at = 32 + 8 * -(-self.many // SAMPLE)
        self.samples = raw[32:at].view("<u8")
        self.lows, self.upper = raw[at : at + lows], raw[at + lows : at + lows + upper]
        self.size = at + lows + upper

    def slice(self, first: int, end: int) -> np.ndarray:
        if first >= end:
            return np.zeros(0, "<u8")
        block = first // SAMPLE
        bit = int(self.samples[block])
        stop = int(self.samples[-(-end // SAMPLE)]) if -(-end // SAMPLE) < len(self.samples) else 8 * len(self.upper)
        ones = np.flatnonzero(np.unpackbits(self.upper[bit // 8 : -(-stop // 8)], bitorder="little")) + bit // 8 * 8
        ones = ones[np.searchsorted(ones, bit) :][first - block * SAMPLE : end - block * SAMPLE]
        high = (ones - np.arange(first, end)).astype("<u8")
        return (high << np.uint64(self.low)) | unpack_bits(self.lows, first, end - first, self.low)

    def all(self) -> np.ndarray:
        return self.slice(0, self.many)


def decode(raw: bytes) -> np.ndarray:
    return EliasFano(np.frombuffer(raw, np.uint8)).all()


def codes(probabilities: np.ndarray) -> np.ndarray:
    return (1 + np.rint((np.maximum(np.log10(probabilities), LOWEST) - LOWEST) / STEP)).astype(np.uint8)


class WordLevel:
    """Level one of one shard, mapped from a file: words by hash, and the share of all tokens that each is."""

    @staticmethod
    def encode(hashes: np.ndarray, counts: np.ndarray, tokens: int) -> bytes:
        """``tokens`` is at least the number of training tokens; shares have 0.1 added to the count."""
        share = np.maximum(np.log10((counts + 0.1) / (tokens + 0.1)), LOWEST_WORD)
        return EliasFano.encode(hashes) + (1 + np.rint((share - LOWEST_WORD) / STEP_WORD)).astype("<u2").tobytes()

    def __init__(self, raw: np.ndarray):
        self.hashes = EliasFano(raw)
        self.codes = raw[self.hashes.size :]

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places from 1, and 16-bit codes, of words in ascending order of their hashes; 0 for those that are absent."""
        place, code = np.zeros(len(hashes), np.int64), np.zeros(len(hashes), "<u2")
        at = 0
        for first in range(0, self.hashes.many, BLOCK):
            own = self.hashes.slice(first, min(first + BLOCK, self.hashes.many))
            end = len(hashes) if first + BLOCK >= self.hashes.many else int(np.searchsorted(hashes, own[-1], "right"))
            met = np.minimum(np.searchsorted(own, hashes[at:end]), len(own) - 1)
            hit = np.flatnonzero(own[met] == hashes[at:end])
            found = first + met[hit]
            place[at + hit] = found + 1
            code[at + hit] = self.codes[2 * first : 2 * (first + len(own))].view("<u2")[found - first]
            at = end
        return place, code


def word_shares(codes_: np.ndarray, tokens: int) -> np.ndarray:
    """Count and 0.1, as the codes of words have it; 0.1 for words that are absent."""
    share = 10.0 ** (LOWEST_WORD + STEP_WORD * (codes_.astype(float) - 1)) * (tokens + 0.1)
    return np.where(codes_ > 0, share, 0.1)


PROBABILITIES = np.concatenate([[0.0], 10.0 ** (LOWEST + STEP * np.arange(255))])


class Level:
    """A level of pairs of one shard, mapped from a file."""

    @staticmethod
    def encode(contexts: np.ndarray, successors: np.ndarray, probabilities: np.ndarray, words: int) -> bytes:
        own, first = np.unique(contexts, return_index=True)
        place = np.searchsorted(own, contexts).astype("<u8")
        numbers = own, np.append(first, len(contexts)).astype("<u8"), place * np.uint64(words) + successors
        return b"".join(map(EliasFano.encode, numbers)) + codes(probabilities).tobytes()

    def __init__(self, raw: np.ndarray, words: int):
        self.words, at, found = words, 0, []
        for _ in range(3):
            found.append(EliasFano(raw[at:]))
            at += found[-1].size
        self.contexts, self.pointers, self.successors = found
        self.codes = raw[at:]

    def find(self, contexts: np.ndarray, successors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places from 1, and 8-bit codes, of pairs in ascending order; 0 for those that are absent."""
        out, asked = (np.zeros(len(contexts), np.int64), np.zeros(len(contexts), np.uint8)), 0
        for begin in range(0, self.contexts.many, BLOCK):
            stop = min(begin + BLOCK, self.contexts.many)
            own, pointers = self.contexts.slice(begin, stop), self.pointers.slice(begin, stop + 1).astype(np.int64)
            upto = int(np.searchsorted(contexts, own[-1], "right"))
            mine = np.arange(asked, upto)
            asked = upto
            place = np.searchsorted(own, contexts[mine])
            known = own[np.minimum(place, len(own) - 1)] == contexts[mine]
            self._within(mine[known], place[known], begin, pointers, successors, out)
        return out

    def _within(self, rows: np.ndarray, place: np.ndarray, begin: int, pointers: np.ndarray, successors: np.ndarray, out: tuple) -> None:
        """Looks up rows whose contexts are at ``place`` of a block that begins at context ``begin``."""
        wanted = (place + begin).astype("<u8") * np.uint64(self.words) + successors[rows]
        at = 0
        while at < len(rows):
            # As many contexts as fill a block; the last one's range is whole.
            first = pointers[place[at]]
            last = max(int(np.searchsorted(pointers, first + BLOCK, "right")) - 1, int(place[at]) + 1)
            end = int(np.searchsorted(place, last))
            range_ = self.successors.slice(int(first), int(pointers[last]))
            met = np.minimum(np.searchsorted(range_, wanted[at:end]), len(range_) - 1)
            hit = range_[met] == wanted[at:end]
            out[0][rows[at:end][hit]] = first + met[hit] + 1
            out[1][rows[at:end][hit]] = self.codes[first + met[hit]]
            at = end


def mapped(raw: bytes, ask):
    """``ask`` the bytes of a level, mapped from a file without a name."""
    with tempfile.TemporaryFile() as file:
        file.write(raw)
        file.flush()
        return ask(np.memmap(file, np.uint8, "r"))


def with_answers(state: DataFrame, answers: DataFrame, how: str) -> DataFrame:
    """Chunks with their answers. Rows meet by part, the key of the buckets; as a second equal key the chunk would call for a shuffle."""
    named = answers.withColumnsRenamed({"part": "own_part", "chunk": "own_chunk"})
    return state.join(named, (F.col("part") == F.col("own_part")) & (F.col("chunk") - F.col("own_chunk") == 0), how).drop("own_part", "own_chunk")


_CHUNKS = "chunk bigint, doc_ids array<bigint>, held_out array<boolean>, ends binary, stream binary, hashes binary, places binary, tokens bigint, docs bigint"
_ARROW = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_(), "double": pa.float64()}
_ARROW |= {f"array<{k}>": pa.list_(v) for k, v in list(_ARROW.items())}


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    fields = [field.split() for field in schema.split(", ")]
    columns = list(zip(*rows)) or [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, _ARROW[kind]) for c, (_, kind) in zip(columns, fields)], names=[n for n, _ in fields])


def _squeeze(values: np.ndarray) -> bytes:
    """32-bit numbers by byte planes, compressed."""
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes())


def _expand(raw: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4")[:, 0].astype(np.int64)


def _squeeze_rising(values: np.ndarray) -> bytes:
    """Places from 1, ascending but for the zeros of what is absent, by the gaps between them."""
    gaps, known = np.zeros(len(values), np.int64), values > 0
    gaps[known] = np.diff(values[known], prepend=0)
    return _squeeze(gaps)


def _expand_rising(raw: bytes) -> np.ndarray:
    gaps = _expand(raw)
    return np.where(gaps > 0, np.cumsum(gaps), 0)


def by_part(df: DataFrame, name: str) -> DataFrame:
    """A table in buckets of ``part``, the task that cut a row's chunk; rows of no chunk are dealt by shard."""
    shard = F.col("shard") if "shard" in df.columns else F.lit(None)
    return bucketed(df.withColumn("part", F.coalesce(F.shiftright("chunk", PART), shard)), "part", name, shuffle="shard" in df.columns)


def chunks(docs: DataFrame, held_out: Column, chunk: int = CHUNK) -> DataFrame:
    """Texts as numbers of words of their chunk; words as hashes."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        part, serial = TaskContext.get().partitionId() << PART, 0
        known, docs_, streams, tokens = {b"": 0}, [], [], 0

        def emit():
            hashes = np.array([xxhash.xxh64_intdigest(word, SEED) for word in known], "<u8")
            hashes, places = np.unique(hashes, return_inverse=True)
            stream = np.concatenate(streams)
            ends = np.cumsum([len(s) for s in streams])
            return _batch(_CHUNKS, [(
                part + serial, [d for d, _ in docs_], [h for _, h in docs_], _squeeze(ends), _squeeze(stream), EliasFano.encode(hashes),
                _squeeze(places), len(stream), sum(not h for _, h in docs_),
            )])

        for batch in slices(batches):
            for doc_id, raw, held in zip(batch.column(0).to_pylist(), batch.column(1).cast("binary").to_pylist(), batch.column(2).to_pylist()):
                own = [known.setdefault(word, len(known)) for word in (raw or b"").lower().split()]
                own.append(0)
                streams.append(np.array(own, np.uint32))
                docs_.append((doc_id, held))
                tokens += len(own)
                if tokens >= chunk:
                    yield emit()
                    known, docs_, streams, tokens, serial = {b"": 0}, [], [], 0, serial + 1
        if docs_:
            yield emit()

    slim = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"), held_out.alias("held_out"))
    return by_part(slim.mapInArrow(encode, _CHUNKS), "chunks")


_ASKED = "chunk bigint, shard bigint, keys binary, sizes binary, words binary, counts binary, totals binary"
_ANSWERS = "chunk bigint, shard bigint, places binary, counts binary, codes binary, level binary, words bigint, tokens bigint"


def _by_shard(shards: np.ndarray):
    """(shard, positions) with positions ascending."""
    order = np.argsort(shards, kind="stable")
    cuts = np.flatnonzero(np.diff(shards[order])) + 1
    return [(int(shards[p[0]]), p) for p in np.split(order, cuts) if len(p)]


def word_level(cut: DataFrame, shards: int, tokens: int) -> DataFrame:
    """Level one: a row per shard with its training words, and an answer per chunk and shard; ``tokens`` are all there are."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one in slices(batches, 1):
            row = one.to_pylist()[0]
            hashes = decode(row["hashes"])
            learned = np.repeat(~np.array(row["held_out"], bool), np.diff(_expand(row["ends"]), prepend=0))
            counts = np.bincount(_expand(row["places"])[_expand(row["stream"])[learned]], minlength=len(hashes))
            # Hash ranges of one size; the upper half of the bits is plenty to tell them apart.
            shard = ((hashes >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)
            rows = [(row["chunk"], s, EliasFano.encode(hashes[p]), None, None, _squeeze(counts[p]), None) for s, p in _by_shard(shard)]
            yield _batch(_ASKED, rows)

    def answer(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        keys = [decode(row["keys"]) for row in rows]
        every, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        counts = np.bincount(inverse, np.concatenate([_expand(row["counts"]) for row in rows]), len(every)).astype(np.int64)
        # Known words are numbered from 1 in the order of their hashes.
        level = WordLevel.encode(every[counts > 0], counts[counts > 0], tokens)
        place, code = mapped(level, lambda raw: WordLevel(raw).find(every))
        out, at = [], 0
        for row, own in zip(rows, keys):
            mine = inverse[at : at + len(own)]
            at += len(own)
            out.append((row["chunk"], row["shard"], _squeeze_rising(place[mine]), _squeeze(counts[mine]), _squeeze(code[mine]), None, 0, 0))
        out.append((None, rows[0]["shard"], None, _squeeze(counts[counts > 0]), None, level, int((counts > 0).sum()), int(counts.sum())))
        return pa.Table.from_batches([_batch(_ANSWERS, out)])

    asked = cut.select("chunk", "held_out", "ends", "stream", "hashes", "places").mapInArrow(ask, _ASKED)
    return by_part(asked.groupBy("shard").applyInArrow(answer, _ANSWERS), "words")


class _Chunk:
    """A chunk whose words have got their numbers (0: unknown), training counts and codes.

    ``context`` names each token's context by its place in the level above, from 1, 0 being none.
    """

    def __init__(self, row: dict, before: dict[int, int], start: tuple[int, int], words: int):
        answers = sorted(row["words"], key=lambda a: a["shard"])
        # Shards are ranges of hashes, so answers in the order of shards are in the order of hashes.
        number, count, code = [], [], []
        for a in answers:
            own = _expand_rising(a["places"])
            number.append(np.where(own > 0, own + before[a["shard"]], 0))
            count.append(_expand(a["counts"]))
            code.append(_expand(a["codes"]))
        places = _expand(row["places"])
        number, count, code = (np.concatenate(own)[places] for own in (number, count, code))
        stream, self.ends = _expand(row["stream"]), _expand(row["ends"])
        self.words, self.chunk = words, row["chunk"]
        self.held_out = np.array(row["held_out"], bool)
        self.begins = np.concatenate([[0], self.ends[:-1]])
        self.word, self.word_count, self.word_code = number[stream], count[stream], code[stream]
        # A document's first word follows the start mark.
        self.follow(self.word, self.word_count, *start)
        self.learned = np.repeat(~self.held_out, np.diff(self.ends, prepend=0))
        self.least = 1

    def follow(self, context: np.ndarray, count: np.ndarray, first: int = 0, first_count: int = 0) -> None:
        """What ends at a token is the context of the next one of its document."""
        self.context, self.context_count = np.roll(context, 1), np.roll(count, 1)
        self.context[self.begins], self.context_count[self.begins] = first, first_count

    def pairs(self, shards: int) -> None:
        """Tokens that ask, the distinct pairs they ask for, and the pairs' shards."""
        self.asks = np.flatnonzero((self.context > 0) & (self.word > 0) & (self.context_count >= self.least))
        contexts, local = np.unique(self.context[self.asks].astype("<u8"), return_inverse=True)
        keys, self.inverse = np.unique(local.astype("<u8") * np.uint64(self.words) + self.word[self.asks].astype("<u8"), return_inverse=True)
        self.pair_context, self.pair_word = contexts[(keys // np.uint64(self.words)).astype(np.int64)], keys % np.uint64(self.words)
        self.totals = np.zeros(len(keys), np.int64)
        self.totals[self.inverse] = self.context_count[self.asks]
        self.parts = _by_shard(_pair_shards(self.pair_context, self.pair_word, self.totals, shards))

    def questions(self, shards: int) -> list[tuple]:
        self.pairs(shards)
        counts = np.bincount(self.inverse, self.learned[self.asks], len(self.totals)).astype(np.int64)
        rows = []
        for shard, p in self.parts:
            own, first, sizes = np.unique(self.pair_context[p], return_index=True, return_counts=True)
            rows.append((self.chunk, shard, EliasFano.encode(own), _squeeze(sizes), _squeeze(self.pair_word[p]), _squeeze(counts[p]), _squeeze(self.totals[p][first])))
        return rows

    def answered(self, answers: list[dict] | None, shards: int) -> np.ndarray:
        """Takes the answers of a level in; returns c(h, w) / c(h) of each token. The pairs are the contexts of the next level."""
        self.pairs(shards)
        code, place, count = (np.zeros(len(self.totals), kind) for kind in (np.uint8, np.int64, np.int64))
        by_shard = {a["shard"]: a for a in answers or []}
        for shard, p in self.parts:
            own = by_shard[shard]
            code[p] = np.frombuffer(own["codes"], np.uint8)
            if own["places"] is not None:
                local, count[p] = _expand_rising(own["places"]), _expand(own["counts"])
                place[p] = np.where(local > 0, (local - 1) * shards + shard + 1, 0)
        found, places, counts = np.zeros(len(self.word)), np.zeros(len(self.word), np.int64), np.zeros(len(self.word), np.int64)
        found[self.asks] = PROBABILITIES[code][self.inverse]
        places[self.asks], counts[self.asks] = place[self.inverse], count[self.inverse]
        self.asked_count = self.context_count
        self.follow(places, counts)
        self.least = 2
        return found


def _mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return values ^ (values >> np.uint64(29))


def _pair_shards(context: np.ndarray, word: np.ndarray, totals: np.ndarray, shards: int) -> np.ndarray:
    """A context has a shard for each ``TOKENS`` / 16 of its tokens; its successors are dealt over them."""
    pieces = np.uint64(1) + totals.astype("<u8") // np.uint64(max(TOKENS // 16, 1))
    return (_mix(context + (_mix(word) % pieces) * np.uint64(0x100000001B3)) % np.uint64(shards)).astype(np.int64)


_PAIRS = "chunk bigint, shard bigint, codes binary, places binary, counts binary, level binary, classes array<bigint>"


def pair_level(asked: DataFrame, words: int, last: bool) -> DataFrame:
    """A level of pairs: a row per shard with its code, and an answer per chunk and shard.

    Places and counts, which the next level needs, are answered for pairs that were seen twice or more.
    """

    def answer(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        sizes = [_expand(row["sizes"]) for row in rows]
        lengths = [int(own.sum()) for own in sizes]
        sizes = np.concatenate(sizes)
        together = lambda read, field: np.concatenate([read(row[field]) for row in rows])
        names, local = np.unique(together(decode, "keys"), return_inverse=True)
        asked = np.repeat(local.astype("<u8") * np.uint64(words), sizes)
        asked += together(_expand, "words").astype("<u8")
        every, inverse = np.unique(asked, return_inverse=True)
        del local, asked
        counts = np.bincount(inverse, together(_expand, "counts"), len(every)).astype(np.int64)
        total = np.zeros(len(every), np.int64)
        total[inverse] = np.repeat(together(_expand, "totals"), sizes)
        context, word = names[(every // np.uint64(words)).astype(np.int64)], every % np.uint64(words)
        seen = counts > 0
        level = Level.encode(context[seen], word[seen], counts[seen] / total[seen], words)
        place, code = mapped(level, lambda raw: Level(raw, words).find(context, word))
        kind = np.log2(np.maximum(total, 1)).astype(np.int64)
        once = np.bincount(kind[counts == 1], minlength=CLASSES).tolist()
        all_ = np.bincount(kind, counts, CLASSES).astype(np.int64).tolist()
        out = [(None, rows[0]["shard"], None, None, None, level, once + all_)]
        again = counts >= 2
        place, counts = np.where(again, place, 0), np.where(again, counts, 0)
        for row, mine in zip(rows, np.split(inverse, np.cumsum(lengths)[:-1])):
            more = (None, None) if last else (_squeeze_rising(place[mine]), _squeeze(counts[mine]))
            out.append((row["chunk"], row["shard"], code[mine].tobytes(), *more, None, None))
        return pa.Table.from_batches([_batch(_PAIRS, out)])

    return by_part(asked.groupBy("shard").applyInArrow(answer, _PAIRS), "pairs")


def back_off(level: DataFrame) -> np.ndarray:
    """Weight of the shorter context, by class of the longer one's frequency."""
    # One row: pairs seen once, and all pairs, of each class of contexts.
    sums = level.filter("chunk is null").agg(*[F.sum(F.col("classes")[i]) for i in range(2 * CLASSES)]).first()
    once, all_ = (np.array([v or 0 for v in half], float) for half in (sums[:CLASSES], sums[CLASSES:]))
    return np.clip((once + 0.5) / (all_ + 1.0), 0.01, 0.99)


def score(docs: DataFrame, held_out: Column, chunk: int = CHUNK, order: int = ORDER) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score); learns where not ``held_out``, a column over doc_id."""
    cut = chunks(docs, held_out, chunk)
    entries = cut.agg(F.sum("tokens").alias("tokens"), F.sum("docs").alias("docs"), F.sum(F.length("hashes")).alias("bytes")).first()
    tokens = entries.tokens or 0
    level_one = word_level(cut, 1 + (entries.bytes or 0) // (6 * WORDS), tokens)
    # One small row per shard.
    shards = level_one.filter("chunk is null").select("shard", "words", "tokens").orderBy("shard").collect()
    before, known, learned = {}, 0, 0
    for row in shards:
        before[row.shard], known, learned = known, known + row.words, learned + row.tokens
    start = known + 1, entries.docs or 0
    words, pair_shards = known + 2, 1 + tokens // TOKENS
    if words >= 1 << 32:
        raise ValueError("words are numbered in 32 bits")

    answers = level_one.filter("chunk is not null").groupBy("part", "chunk")
    answers = answers.agg(F.collect_list(F.struct("shard", "places", "counts", "codes")).alias("words"))
    state = with_answers(cut, answers, "inner")
    columns = ["chunk", "held_out", "ends", "stream", "places", "words"]
    weights: list[np.ndarray] = []
    for n in range(2, order + 1):
        above = [f"level{m}" for m in range(2, n)]

        def questions(row: dict, above: list[str]) -> pa.RecordBatch:
            own = _Chunk(row, before, start, words)
            for name in above:
                own.answered(row[name], pair_shards)
            return _batch(_ASKED, own.questions(pair_shards))

        def ask(batches: Iterator[pa.RecordBatch], above=above) -> Iterator[pa.RecordBatch]:
            for one in slices(batches, 1):
                yield questions(one.to_pylist()[0], above)

        level = pair_level(state.select(*columns, *above).mapInArrow(ask, _ASKED), words, n == order)
        weights.append(back_off(level))
        fields = F.struct("shard", "codes", "places", "counts")
        found = level.filter("chunk is not null").groupBy("part", "chunk").agg(F.collect_list(fields).alias(f"level{n}"))
        state = with_answers(state, found, "left")
    norm = learned + 0.1 * (known + 1)
    levels = [f"level{n}" for n in range(2, order + 1)]

    def scored(row: dict) -> pa.RecordBatch:
        own = _Chunk(row, before, start, words)
        base, p = (own.word_count + 0.1) / norm, word_shares(own.word_code, tokens) / norm
        for name, weight in zip(levels, weights):
            least = own.least
            found = own.answered(row[name], pair_shards)
            count = own.asked_count
            b = np.where(count >= least, weight[np.log2(np.maximum(count, 1)).astype(np.int64)], 1.0)
            p = (1 - b) * found + b * p
        add = lambda values: np.add.reduceat(values, own.begins)
        arrays = [
            pa.array(row["doc_ids"], pa.int64()), pa.array(row["held_out"], pa.bool_()), pa.array(np.diff(own.ends, prepend=0)),
            pa.array(add((own.word_count > 0).astype(np.int64))), pa.array(np.full(len(own.begins), learned, np.int64)),
            pa.array(add(np.log10(base))), pa.array(add(np.log10(p))),
        ]
        return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one in slices(batches, 1):
            yield scored(one.to_pylist()[0])

    finished = state.select(*columns, "doc_ids", *levels)
    return finished.mapInArrow(finish, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
