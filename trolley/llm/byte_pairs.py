"""Byte-level BPE of whole texts and back, with token offsets.

Texts are cut without a regex. Every code point gets a class (with what follows it told
apart where the cut needs it), every class is a function from the state of the scan to
the next state, and such functions compose associatively. There are few different
compositions, so they are numbered and composed by one table look-up: blocks are
composed side by side, then the blocks' products are scanned in the same way, then the
states inside the blocks follow from those at their starts. The slices between the cuts
are merged pair by pair, all new ones of a group side by side; their ids are kept in a bounded cache.
"""

from __future__ import annotations

import base64
import heapq
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text whose classes are scanned together; longer texts are scanned whole, their slices merged in parts.
GROUP = 1 << 19
#: Functions composed one after the other within a block.
BLOCK = 64
#: Distinct slices kept with their ids, besides those of a group.
KEPT = 100_000
#: From so many bytes on a slice is merged alone, by a heap, and not kept.
LONG_SLICE = 64

#: White space of the cutting pattern.
SPACES = (9, 10, 11, 12, 13, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288)

# Classes of code points as the scan sees them.
LETTER, NUMBER, OTHER, SHORT, LONG, JOINING, LAST, SPACE, END = range(9)
# States: what the code point before belongs to.
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, BLANK, IN_SPACES, ONE_MORE, TWO_MORE = range(8)


def _machine() -> tuple[np.ndarray, np.ndarray]:
    """(next state, whether a slice begins) by class and state.

    SHORT and LONG are apostrophes before one or two letters that make a slice of their
    own where a slice begins; JOINING is the blank before something else, LAST another
    white space there; END stands between texts.
    """
    step, cut = np.zeros((9, 8), dtype=np.uint8), np.ones((9, 8), dtype=bool)
    for kind, inside in ((LETTER, IN_LETTERS), (NUMBER, IN_NUMBERS), (OTHER, IN_OTHERS)):
        step[kind] = inside
        cut[kind, [inside, BLANK]] = False
    for kind, pending in ((SHORT, ONE_MORE), (LONG, TWO_MORE)):
        step[kind] = pending
        step[kind, [IN_OTHERS, BLANK]] = IN_OTHERS
        cut[kind, [IN_OTHERS, BLANK]] = False
    step[JOINING], step[LAST], step[SPACE], step[END] = BLANK, FRESH, IN_SPACES, FRESH
    cut[SPACE, IN_SPACES] = False
    step[:END, ONE_MORE], step[:END, TWO_MORE] = FRESH, ONE_MORE
    cut[:END, [ONE_MORE, TWO_MORE]] = False
    return step, cut


STEP, CUT = _machine()


def _compositions() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of each class's function, table of compositions, functions by number); 0 is the identity."""
    functions = [tuple(range(8))]
    number = {functions[0]: 0}
    classes = [tuple(int(x) for x in row) for row in STEP]
    for f in functions:
        for g in classes:
            both = tuple(g[x] for x in f)
            if both not in number:
                number[both] = len(functions)
                functions.append(both)
    table = np.array([[number[tuple(g[x] for x in f)] for g in functions] for f in functions], dtype=np.uint8 if len(functions) <= 256 else np.uint16)
    return np.array([number[c] for c in classes], dtype=table.dtype), table, np.array(functions, dtype=np.uint8)


OF_CLASS, COMPOSED, FUNCTIONS = _compositions()


def _before(functions: np.ndarray) -> np.ndarray:
    """The composition of all functions before each one (exclusive scan)."""
    n = len(functions)
    if n <= BLOCK:
        out, so_far = np.zeros(n, dtype=COMPOSED.dtype), 0
        for i, f in enumerate(functions):
            out[i] = so_far
            so_far = COMPOSED[so_far, f]
        return out
    rows = np.zeros((-(-n // BLOCK), BLOCK), dtype=functions.dtype)
    rows.reshape(-1)[:n] = functions
    inner = np.zeros_like(rows)
    for j in range(1, BLOCK):
        inner[:, j] = COMPOSED[inner[:, j - 1], rows[:, j - 1]]
    outer = _before(COMPOSED[inner[:, -1], rows[:, -1]])
    return COMPOSED[outer[:, None], inner].reshape(-1)[:n]


@lru_cache(maxsize=1)
def class_table() -> np.ndarray:
    """LETTER, NUMBER, SPACE or OTHER of every code point, as the library's own tables have them (Unicode versions differ)."""
    import tiktoken

    points = np.array([c for c in range(0x110000) if not 0xD800 <= c < 0xE000], dtype="<u4").tobytes().decode("utf-32-le")
    out = np.full(0x110000, OTHER, dtype=np.uint8)
    for name, kind in (("L", LETTER), ("N", NUMBER)):
        bytewise = tiktoken.Encoding(name, pat_str=rf"\p{{{name}}}+", mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={})
        found = bytes(bytewise.encode_ordinary(points)).decode()
        out[np.frombuffer(found.encode("utf-32-le"), dtype="<u4")] = kind
    out[list(SPACES)] = SPACE
    return out


def _followed_by(points: np.ndarray, at: np.ndarray, letters: str) -> np.ndarray:
    ok = at + len(letters) < len(points)
    for i, c in enumerate(letters, 1):
        ok &= points[np.minimum(at + i, len(points) - 1)] == ord(c)
    return ok


def slice_starts(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where slices begin among code points of several texts; ``ends`` are places of separators, each a slice of its own."""
    kinds = class_table()[points]
    kinds[ends] = END
    quotes = np.flatnonzero(points == ord("'"))
    quotes = quotes[kinds[quotes] != END]
    for letters, kind in (("s", SHORT), ("t", SHORT), ("m", SHORT), ("d", SHORT), ("re", LONG), ("ve", LONG), ("ll", LONG)):
        kinds[quotes[_followed_by(points, quotes, letters) & (kinds[np.minimum(quotes + 1, len(kinds) - 1)] != END)]] = kind
    blank = kinds == SPACE
    last = np.flatnonzero(blank[:-1] & ~blank[1:] & (kinds[1:] != END))
    kinds[last] = np.where(points[last] == 32, JOINING, LAST)
    states = FUNCTIONS[_before(OF_CLASS[kinds]), FRESH]
    return np.flatnonzero(CUT[kinds, states])


@lru_cache(maxsize=2)
def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def merge_pairs(data: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one long slice that is no token itself: the adjacent pair of the lowest rank is joined, the first one
    if tied, until none has a rank; a heap finds it."""
    n = len(data)
    stop, before = list(range(1, n + 1)), list(range(-1, n - 1))
    waiting = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(data[i : i + 2])) is not None]
    heapq.heapify(waiting)
    alive = bytearray(b"\x01") * n
    while waiting:
        _, i, end = heapq.heappop(waiting)
        if not alive[i] or (j := stop[i]) >= n or stop[j] != end:
            continue
        alive[j], stop[i] = 0, end
        if end < n:
            before[end] = i
            if (r := ranks.get(data[i : stop[end]])) is not None:
                heapq.heappush(waiting, (r, i, stop[end]))
        if (p := before[i]) >= 0 and (r := ranks.get(data[p:end])) is not None:
            heapq.heappush(waiting, (r, p, end))
    out, i = [], 0
    while i < n:
        out.append(ranks[data[i : stop[i]]])
        i = stop[i]
    return out


@lru_cache(maxsize=2)
def pair_ranks(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids of single bytes, sorted keys of pairs of ids whose bytes together are a token, that token's id)."""
    ranks = read_ranks(path)
    keys, ids = [], []
    for token, i in ranks.items():
        for k in range(1, len(token)):
            if (a := ranks.get(token[:k])) is not None and (b := ranks.get(token[k:])) is not None:
                keys.append(a << 32 | b)
                ids.append(i)
    keys, ids = np.array(keys, dtype=np.int64), np.array(ids, dtype=np.int64)
    order = np.argsort(keys)
    return np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64), keys[order], ids[order]


NONE = np.int64(1 << 40)


def _rank_of(a: np.ndarray, b: np.ndarray, keys: np.ndarray, ids: np.ndarray) -> np.ndarray:
    wanted = a << 32 | b
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, ids[at], NONE)


def merge_slices(slices: list[bytes], path: str) -> list[bytes]:
    """Ids of many short slices, packed: each round joins one pair in every slice that still has one."""
    of_byte, keys, ids = pair_ranks(path)
    sizes = np.array([len(x) for x in slices], dtype=np.int64)
    tokens = of_byte[np.frombuffer(b"".join(slices), dtype=np.uint8)]
    own = np.repeat(np.arange(len(slices)), sizes)  # the slice of each token
    following = np.append(own[1:] == own[:-1], False) if len(own) else np.zeros(0, bool)
    pairs = np.full(len(tokens), NONE)
    at = np.flatnonzero(following)
    pairs[at] = _rank_of(tokens[at], tokens[at + 1], keys, ids)
    out: list[bytes] = [b""] * len(slices)
    while len(tokens):
        starts = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        lengths = np.diff(np.append(starts, len(own)))
        least = np.minimum.reduceat(pairs, starts)
        done = least == NONE
        if done.any():
            packed = tokens.astype("<u4").tobytes()
            for i, a, n in zip(own[starts[done]].tolist(), starts[done].tolist(), lengths[done].tolist(), strict=True):
                out[i] = packed[4 * a : 4 * (a + n)]
            left = np.repeat(~done, lengths)
            tokens, pairs, own = tokens[left], pairs[left], own[left]
            least, lengths = least[~done], lengths[~done]
            if not len(tokens):
                break
        best = np.flatnonzero(pairs == np.repeat(least, lengths))
        best = best[np.append(True, own[best[1:]] != own[best[:-1]])]  # the first of each slice
        tokens[best] = pairs[best]
        stays = np.ones(len(tokens), dtype=bool)
        stays[best + 1] = False
        place = best - np.arange(len(best))  # one token before each has gone for each slice before
        tokens, pairs, own = tokens[stays], pairs[stays], own[stays]
        for i in (place, place[place > 0] - 1):
            here = (i + 1 < len(own)) & (own[i] == own[np.minimum(i + 1, len(own) - 1)])
            fresh = np.full(len(i), NONE)
            fresh[here] = _rank_of(tokens[i[here]], tokens[i[here] + 1], keys, ids)
            pairs[i] = fresh
    return out


@lru_cache(maxsize=2)
def whole_tokens(path: str) -> dict[str, bytes]:
    """Packed id of every token that is text by itself."""
    out = {}
    for token, i in read_ranks(path).items():
        try:
            out[token.decode()] = i.to_bytes(4, "little")
        except UnicodeDecodeError:
            continue
    return out


class SliceCache(dict):
    """Slice of text -> its ids as bytes of little-endian 32-bit numbers; beyond ``KEPT`` slices it starts anew."""

    def __init__(self, path: str):
        super().__init__(whole_tokens(path))
        self.path = path

    def encode(self, slices: list[str]) -> list[bytes]:
        if len(self) > KEPT + len(whole_tokens(self.path)):
            self.clear()
            self.update(whole_tokens(self.path))
        out = list(map(self.get, slices))
        places = [i for i, x in enumerate(out) if x is None]
        new = list({slices[i] for i in places})
        data = list(map(str.encode, new))
        short = [i for i, x in enumerate(data) if len(x) < LONG_SLICE]
        self.update(zip([new[i] for i in short], merge_slices([data[i] for i in short], self.path), strict=True))
        ranks = read_ranks(self.path)
        alone = {t: np.array(merge_pairs(x, ranks), dtype="<u4").tobytes() for t, x in zip(new, data, strict=True) if len(x) >= LONG_SLICE}
        for i in places:
            out[i] = alone.get(slices[i]) or self[slices[i]]
        return out


def encode_texts(texts: list[str], cache: SliceCache) -> list[np.ndarray]:
    """The ids of each text."""
    joined = "\x00".join(texts) + "\x00"
    points = np.frombuffer(joined.encode("utf-32-le"), dtype="<u4")
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    starts = slice_starts(points, ends)
    del points
    separators = np.searchsorted(starts, ends)
    bounds = np.append(starts, len(joined))
    packed, sizes = [], []
    for a in range(0, len(starts), GROUP):
        own = bounds[a : a + GROUP + 1].tolist()
        got = cache.encode([joined[x:y] for x, y in zip(own, own[1:], strict=False)])
        for i in separators[(separators >= a) & (separators < a + GROUP)].tolist():
            got[i - a] = b""
        packed.append(b"".join(got))
        sizes.append(np.fromiter(map(len, got), dtype=np.int64, count=len(got)) // 4)
    ids = np.frombuffer(b"".join(packed), dtype="<u4")
    before = np.concatenate(([0], np.cumsum(np.concatenate(sizes))))
    return np.split(ids, before[separators])[: len(texts)]


@lru_cache(maxsize=2)
def _tokens(path: str) -> tuple[np.ndarray, np.ndarray, bytes]:
    """(start, length) by id in the bytes of all tokens; length -1 for ids that are not there."""
    ranks = read_ranks(path)
    start, length, pool = np.zeros(max(ranks.values()) + 1, np.int64), np.full(max(ranks.values()) + 1, -1, np.int64), bytearray()
    for token, i in ranks.items():
        start[i], length[i] = len(pool), len(token)
        pool += token
    return start, length, bytes(pool)


def token_ends(ids: np.ndarray, path: str) -> np.ndarray:
    """Byte offsets at which the tokens end in the UTF-8 text."""
    return np.cumsum(_tokens(path)[1][ids])


def decode_ids(ids: np.ndarray, ends: np.ndarray, path: str) -> bytes:
    """The bytes of ``ids``, each token put where its offset says."""
    start, length, pool = _tokens(path)
    if not len(ids):
        return b""
    sizes = length[ids]
    if (sizes < 0).any() or not np.array_equal(np.cumsum(sizes), ends):
        raise ValueError("ids and offsets are not of one vocabulary")
    out = np.arange(int(ends[-1]), dtype=np.int64)
    out += np.repeat(start[ids] - (ends - sizes), sizes)
    return np.frombuffer(pool, dtype=np.uint8)[out].tobytes()


def default_ranks() -> str:
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def _in_groups(sizes: list[int]):
    """(from, to) of consecutive texts of about ``GROUP`` bytes together."""
    a = total = 0
    for b, size in enumerate(sizes):
        if b > a and total + size > GROUP:
            yield a, b
            a, total = b, 0
        total += size
    if a < len(sizes):
        yield a, len(sizes)


def encode_documents(docs: DataFrame, ranks: str | None = None) -> DataFrame:
    """doc_id, ids, ends: the token ids of each whole text and the byte offsets at which they end.

    ``docs`` has doc_id and text; other columns take no part. ``ranks`` is the path of a
    rank file, at the same place on every machine. Null text counts as empty and has no
    ids; repeated rows are encoded each; null ids stay null. No row is shuffled. Memory of a
    task: about 30 bytes for each code point of its longest text or of a group of half a million.
    """
    path = ranks or default_ranks()

    def encode(batches):
        cache = SliceCache(path)
        for batch in batches:
            doc_ids, texts = batch.column(0), batch.column(1)
            for a, b in _in_groups(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
                found = encode_texts([x or "" for x in texts.slice(a, b - a).to_pylist()], cache)
                sizes = np.concatenate(([0], np.cumsum([len(x) for x in found]))).astype(np.int32)
                ends = [token_ends(x, path) for x in found]
                lists = [
                    pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(np.concatenate(x).astype(kind)))
                    for x, kind in ((found, np.int32), (ends, np.int64))
                ]
                yield pa.RecordBatch.from_arrays([doc_ids.slice(a, b - a), *lists], ["doc_id", "ids", "ends"])

    shape = "doc_id long, ids array<int>, ends array<long>"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(encode, shape)


def decode_documents(encoded: DataFrame, ranks: str | None = None) -> DataFrame:
    """doc_id, n_tokens, packed (ids as little-endian 32-bit numbers) and data, the decoded UTF-8 bytes.

    ``encoded`` has doc_id, ids and ends as ``encode_documents`` gives them; null ids or
    ends count as none. Raises ValueError where ids and offsets do not agree.
    """
    path = ranks or default_ranks()

    kinds = {"doc_id": pa.int64(), "n_tokens": pa.int64(), "packed": pa.binary(), "data": pa.binary()}

    def decode(batches):
        for batch in batches:
            rows, size = [], 0
            for k, doc_id in enumerate(batch.column(0).to_pylist()):
                lists = [batch.column(c)[k] for c in (1, 2)]
                ids, ends = (np.asarray(x.values if x.is_valid else [], dtype=np.int64) for x in lists)
                rows.append((doc_id, len(ids), ids.astype("<u4").tobytes(), decode_ids(ids, ends, path)))
                size += len(rows[-1][3])
                if size > GROUP:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds.values())], [*kinds])
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds.values())], [*kinds])

    shape = "doc_id long, n_tokens long, packed binary, data binary"
    return encoded.select(F.col("doc_id").cast("long"), "ids", "ends").mapInArrow(decode, shape)


def round_trip_digests(docs: DataFrame, ranks: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every text, encoded and decoded again."""
    back = decode_documents(encode_documents(docs, ranks), ranks)
    return back.select(
        "doc_id", "n_tokens", F.sha2("packed", 256).alias("ids_sha256"), F.sha2("data", 256).alias("decoded_sha256")
    )
