"""SentencePiece BPE by vectorised merge rounds, and its decoding.

A batch of texts is cut into words where no merge can cross: a piece holds the
space mark only at its front, and some marks never follow a letter inside a
piece.  Each distinct word is encoded once.  The symbols of all new words lie in one flat
array; a round looks up the rank of every neighbouring pair, takes the minimum
per word, merges that pair at all its places from the left at once, and
compacts, until no word has a pair left.

Merging all places at once is the same as one after the other unless a merge
makes a pair that would come before the next place.  Words where that happens,
and words of more than ``LONG_WORD`` symbols (where a round per rank would be
slow), go through the plain priority queue, with the same result.

The model file is read on the driver through the library's reader; its tables
(a few MB, fixed by the vocabulary) are broadcast.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from isobar.llm.text import text_udf

MARK = "▁"
NEVER = np.int64(1) << 40
LONG_WORD = 2000
CHARS_AT_ONCE = 1_000_000
WORDS_KEPT = 300_000


@dataclass
class Vocabulary:
    """Tables of a BPE model with byte fallback.

    Symbols are the pieces and the single characters inside them; any other
    character is ``symbols`` + its code point.  ``keys`` are the sorted pairs
    left * stride + right that make a piece, with ``rank`` (0 is merged first)
    and ``made``.
    """

    keys: np.ndarray
    rank: np.ndarray
    made: np.ndarray
    characters: dict[int, int]
    symbols: int
    piece_id: np.ndarray
    codepoint: np.ndarray
    byte_id: np.ndarray
    surface: list[bytes]
    is_byte: np.ndarray
    bos: int
    eos: int
    splitter: str
    dummy_prefix: bool = True
    marked: np.ndarray = field(default_factory=lambda: np.empty(0, bool))

    @property
    def stride(self) -> int:
        return self.symbols + 0x110000


def vocabulary(path: str) -> Vocabulary:
    """Read a model: BPE, byte fallback, no normalisation beyond the leading space mark."""
    from sentencepiece import SentencePieceProcessor
    from sentencepiece import sentencepiece_model_pb2 as proto

    with open(path, "rb") as file:
        content = file.read()
    model, spec = SentencePieceProcessor(model_proto=content), proto.ModelProto()
    spec.ParseFromString(content)
    norm = spec.normalizer_spec
    if spec.trainer_spec.model_type != 2 or not spec.trainer_spec.byte_fallback or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
        raise ValueError("only BPE models with byte fallback and without normalisation are supported")
    size = model.get_piece_size()
    pieces = [model.id_to_piece(i) for i in range(size)]
    special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) for i in range(size)]
    normal = {p: i for i, p in enumerate(pieces) if not special[i]}
    symbol = {p: n for n, p in enumerate(normal)}
    for character in sorted({c for p in normal for c in p}):
        symbol.setdefault(character, len(symbol))
    count = len(symbol)
    stride = count + 0x110000
    order = {s: n for n, s in enumerate(sorted({model.get_score(i) for i in normal.values()}, reverse=True))}
    pairs = sorted(
        (symbol[p[:cut]] * stride + symbol[p[cut:]], order[model.get_score(i)], symbol[p])
        for p, i in normal.items()
        for cut in range(1, len(p))
        if p[:cut] in symbol and p[cut:] in symbol
    )
    table = np.array(pairs, np.int64).reshape(-1, 3)
    piece_id, codepoint = np.full(count, -1, np.int64), np.full(count, -1, np.int64)
    for p, n in symbol.items():
        piece_id[n] = normal.get(p, -1)
        codepoint[n] = ord(p) if len(p) == 1 else -1
    byte_id = np.zeros(256, np.int64)
    surface = []
    for i, p in enumerate(pieces):
        if model.is_byte(i):
            byte_id[int(p[3:5], 16)] = i
            surface.append(bytes([int(p[3:5], 16)]))
        elif model.is_unknown(i):
            surface.append(spec.trainer_spec.unk_surface.encode())
        else:
            surface.append(b"" if model.is_control(i) else p.replace(MARK, " ").encode())
    alone = "".join(c for c in "\n\r\t" if not any(c in p and len(p) > 1 for p in normal))
    cut = all(MARK not in p.lstrip(MARK) for p in normal)
    # Characters that follow none but each other inside pieces: a word may end before them.
    pairs_in = {p[k : k + 2] for p in normal for k in range(len(p) - 1)}
    heads = {chr(c) for c in range(33, 127) if not chr(c).isalnum()}
    while any(q[1] in heads and q[0] not in heads and q[0] != MARK for q in pairs_in):
        heads -= {q[1] for q in pairs_in if q[0] not in heads and q[0] != MARK}
    head = re.escape("".join(sorted(heads)))
    return Vocabulary(
        keys=np.ascontiguousarray(table[:, 0]),
        rank=np.ascontiguousarray(table[:, 1]),
        made=np.ascontiguousarray(table[:, 2]),
        characters={ord(p): n for p, n in symbol.items() if len(p) == 1},
        symbols=count,
        piece_id=piece_id,
        codepoint=codepoint,
        byte_id=byte_id,
        surface=surface,
        is_byte=np.array([model.is_byte(i) for i in range(size)]),
        bos=model.bos_id(),
        eos=model.eos_id(),
        splitter="(?s).+" if not cut else "|".join(
            ([f"{MARK}*[^{MARK}{alone}{head}]+", f"{MARK}*[{head}][^{MARK}{alone}]*", f"{MARK}+"] if heads else [f"{MARK}+[^{MARK}{alone}]*", f"[^{MARK}{alone}]+"])
            + ([f"[{alone}]"] if alone else [])
        ),
        dummy_prefix=norm.add_dummy_prefix,
        marked=np.array([p.startswith(MARK) and not special[i] for i, p in enumerate(pieces)]),
    )


class Encoder:
    """Encodes batches of texts; remembers a bounded number of words."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.split = re.compile(vocab.splitter).findall
        self.symbol_of = np.arange(0x110000, dtype=np.int64) + vocab.symbols
        self.symbol_of[np.fromiter(vocab.characters.keys(), np.int64)] = np.fromiter(vocab.characters.values(), np.int64)
        self.forget()

    def forget(self) -> None:
        self.slots: dict[str, int] = {}
        self.flat, self.edges = np.empty(0, np.int64), np.zeros(1, np.int64)

    def looked_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and made symbol of each pair; NEVER where there is none."""
        v = self.vocab
        key = left * v.stride + right
        at = np.minimum(np.searchsorted(v.keys, key), len(v.keys) - 1)
        hit = v.keys[at] == key
        return np.where(hit, v.rank[at], NEVER), np.where(hit, v.made[at], -1)

    def one_by_one(self, symbols: list[int]) -> list[int]:
        """Merge a single word with a priority queue: lowest rank first, then leftmost."""
        v = self.vocab
        n = len(symbols)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        queue: list[tuple[int, int, int, int, int]] = []
        known: dict[tuple[int, int], tuple[int, int]] = {}

        def offer(a: int, b: int) -> None:
            pair = (symbols[a], symbols[b])
            if pair not in known:
                rank, made = self.looked_up(np.array([pair[0]]), np.array([pair[1]]))
                known[pair] = (int(rank[0]), int(made[0]))
            rank, made = known[pair]
            if rank < NEVER:
                heapq.heappush(queue, (rank, a, b, *pair))

        for a in range(n - 1):
            offer(a, a + 1)
        while queue:
            _, a, b, left, right = heapq.heappop(queue)
            if not (alive[a] and alive[b] and after[a] == b and symbols[a] == left and symbols[b] == right):
                continue
            symbols[a] = known[left, right][1]
            alive[b] = False
            after[a] = after[b]
            if after[a] < n:
                before[after[a]] = a
                offer(a, after[a])
            if before[a] >= 0:
                offer(before[a], a)
        return [s for s, kept in zip(symbols, alive) if kept]

    def merged(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of words after all merges, flat, and how many each word has."""
        out: list[tuple[np.ndarray, np.ndarray]] = []  # (word, symbol) of finished words

        def alone(w: int, own: np.ndarray) -> None:
            left = np.array(self.one_by_one(own.tolist()), np.int64)
            out.append((np.full(len(left), w), left))

        word = np.repeat(np.arange(len(sizes)), sizes)
        edges = np.concatenate(([0], np.cumsum(sizes)))
        for w in np.flatnonzero(sizes > LONG_WORD):
            alone(w, symbols[edges[w] : edges[w + 1]])
        keep = sizes[word] <= LONG_WORD
        symbols, word = symbols[keep], word[keep]
        rank, made = np.full(len(symbols), NEVER), np.full(len(symbols), -1, np.int64)
        stale = np.arange(len(symbols))  # places whose pair with the next symbol is to be looked up
        while len(symbols):
            stale = stale[stale < len(symbols) - 1]
            paired = word[stale] == word[stale + 1]
            rank[stale] = NEVER
            stale = stale[paired]
            rank[stale], made[stale] = self.looked_up(symbols[stale], symbols[stale + 1])
            rank[-1] = NEVER
            starts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            counts = np.diff(np.append(starts, len(symbols)))
            least = np.minimum.reduceat(rank, starts)
            ended = np.repeat(least == NEVER, counts)
            if ended.any():
                out.append((word[ended], symbols[ended]))
                symbols, word, rank, made = symbols[~ended], word[~ended], rank[~ended], made[~ended]
                if not len(symbols):
                    break
                live = least < NEVER
                least, counts = least[live], counts[live]
                starts = np.concatenate(([0], np.cumsum(counts)[:-1]))
            # Every other place of a run of candidates that touch, from the left.
            candidate = rank == np.repeat(least, counts)
            index = np.arange(len(symbols))
            begins = candidate & ~np.concatenate(([False], candidate[:-1]))
            first = np.maximum.accumulate(np.where(begins, index, 0))
            chosen = candidate & ((index - first) % 2 == 0)
            places = np.flatnonzero(chosen)
            many = np.repeat(np.add.reduceat(chosen, starts, dtype=np.int64) > 1, counts)
            risky = self.early(symbols, word, made, chosen, places[many[places]], rank) if many.any() else places[:0]
            gone = np.concatenate(([False], chosen[:-1]))
            symbols = np.where(chosen, made, symbols) if not len(risky) else symbols
            if len(risky):
                for w in np.unique(word[risky]):
                    alone(w, symbols[word == w])
                gone |= np.isin(word, word[risky])
                symbols = np.where(chosen, made, symbols)
            kept = ~gone
            place = np.cumsum(kept) - 1
            changed = place[chosen & kept]
            symbols, word, rank, made = symbols[kept], word[kept], rank[kept], made[kept]
            stale = np.concatenate((changed, changed[changed > 0] - 1))
        words = np.concatenate([w for w, _ in out]) if out else np.empty(0, np.int64)
        order = np.argsort(words, kind="stable")
        flat = np.concatenate([x for _, x in out])[order] if out else np.empty(0, np.int64)
        return flat, np.bincount(words, minlength=len(sizes))

    def early(self, symbols, word, made, chosen, places, rank) -> np.ndarray:
        """Of ``places``, those where the new symbol would make a pair that comes no later than the merge itself."""
        last = len(symbols) - 1
        made_here, limit = made[places], rank[places]
        bad = np.zeros(len(places), bool)
        left, right = np.maximum(places - 1, 0), np.minimum(places + 2, last)
        has_left = (places > 0) & (word[left] == word[places])
        has_right = (places + 2 <= last) & (word[right] == word[places])
        merged_left = np.maximum(places - 2, 0)
        merges_left = has_left & (places > 1) & chosen[merged_left]
        for ok, a, b in (
            (has_left, symbols[left], made_here),
            (has_right, made_here, symbols[right]),
            (merges_left, np.where(merges_left, made[merged_left], 0), made_here),
        ):
            bad |= ok & (self.looked_up(a, b)[0] <= limit)
        return places[bad]

    def learn(self, new: list[str]) -> None:
        """Encode new words and remember them."""
        v = self.vocab
        joined = "".join(new)
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        symbols, lengths = self.merged(self.symbol_of[points], np.array([len(w) for w in new], np.int64))
        known = symbols < v.symbols
        ids = np.where(known, v.piece_id[np.where(known, symbols, 0)], -1)
        odd = np.flatnonzero(ids < 0)  # characters without a piece become bytes
        if len(odd):
            points = [int(v.codepoint[x]) if x < v.symbols else x - v.symbols for x in symbols[odd].tolist()]
            coded = [chr(x).encode("utf-8", "surrogatepass") for x in points]
            repeats = np.ones(len(ids), np.int64)
            repeats[odd] = [len(c) for c in coded]
            word = np.repeat(np.repeat(np.arange(len(new)), lengths), repeats)
            ids = np.repeat(ids, repeats)
            ids[ids < 0] = v.byte_id[np.frombuffer(b"".join(coded), np.uint8)]
            lengths = np.bincount(word, minlength=len(new))
        self.slots |= {w: len(self.edges) - 1 + n for n, w in enumerate(new)}
        self.flat = np.concatenate((self.flat, ids))
        self.edges = np.concatenate((self.edges, self.edges[-1] + np.cumsum(lengths)))

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text, without begin and end."""
        out: list[np.ndarray] = []
        begin = 0
        while begin < len(texts):
            end, chars = begin, 0
            while end < len(texts) and (end == begin or chars + len(texts[end] or "") <= CHARS_AT_ONCE):
                chars += len(texts[end] or "")
                end += 1
            out += self._some(texts[begin:end])
            begin = end
        return out

    def _some(self, texts: list[str | None]) -> list[np.ndarray]:
        words, counts = [], []
        prefix = MARK if self.vocab.dummy_prefix else ""
        for text in texts:
            found = self.split(prefix + text.replace(" ", MARK)) if text else []
            words += found
            counts.append(len(found))
        if len(self.slots) > WORDS_KEPT:
            self.forget()
        slots = self.slots
        new = [w for w in dict.fromkeys(words) if w not in slots]
        if new:
            self.learn(new)
        at = np.fromiter(map(slots.__getitem__, words), np.int64, len(words))
        starts, lengths = self.edges[at], self.edges[at + 1] - self.edges[at]
        ends = np.cumsum(lengths)
        flat = self.flat[np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)]
        cuts = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(counts)))]
        return [flat[a:b] for a, b in zip(cuts, cuts[1:])]


def decoded(vocab: Vocabulary, ids: np.ndarray) -> str:
    """The text of ids: space marks as spaces without the first one, bytes as UTF-8, each wrong byte as U+FFFD."""
    listed = ids.tolist()
    surface = vocab.surface
    joined = b"".join([surface[i] for i in listed])
    first = next((i for i in listed if surface[i]), None)
    if vocab.dummy_prefix and first is not None and vocab.marked[first]:
        joined = joined[1:]
    try:
        return joined.decode("utf-8")
    except UnicodeDecodeError:
        return _mended(joined)


def _mended(joined: bytes) -> str:
    out, at = [], 0
    while at < len(joined):
        for width in (1, 2, 3, 4):
            try:
                out.append(joined[at : at + width].decode("utf-8"))
                at += width
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


def _with_ends(vocab: Vocabulary, ids: np.ndarray, ends: bool) -> np.ndarray:
    return np.concatenate(([vocab.bos], ids, [vocab.eos])) if ends else ids


def encode(spark: SparkSession, text: Column, path: str, *, ends: bool = True) -> Column:
    """Ids of a text column as array<int>, with begin and end ids if ``ends``; NULL counts as empty."""
    shared = spark.sparkContext.broadcast(vocabulary(path))

    def run(batches):
        encoder = Encoder(shared.value)
        for texts in batches:
            ids = [_with_ends(encoder.vocab, x, ends).astype(np.int32) for x in encoder.encode(texts.to_pylist())]
            edges = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
            flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
            yield pa.ListArray.from_arrays(pa.array(edges), pa.array(flat))

    return text_udf(_streamed(run), "array<int>")(text)


def decode(spark: SparkSession, ids: Column, path: str) -> Column:
    """The text of an array of ids; NULL counts as empty."""
    shared = spark.sparkContext.broadcast(vocabulary(path))

    def run(batches):
        for lists in batches:
            yield pa.array([decoded(shared.value, np.array(x or [], np.int64)) for x in lists.to_pylist()], pa.string())

    return text_udf(_streamed(run), "string")(ids)


def coded(spark: SparkSession, text: Column, path: str) -> Column:
    """``ids decoded_sha256`` of a text: its ids with begin and end, and the digest of the text they decode to, in one pass."""
    shared = spark.sparkContext.broadcast(vocabulary(path))

    def run(batches):
        encoder = Encoder(shared.value)
        for texts in batches:
            ids, plain = [], []
            for some in encoder.encode(texts.to_pylist()):
                whole = _with_ends(encoder.vocab, some, True)
                ids.append(whole.astype(np.int32))
                plain.append(hashlib.sha256(decoded(encoder.vocab, whole).encode("utf-8", "surrogatepass")).hexdigest())
            edges = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(edges), pa.array(np.concatenate(ids) if ids else np.empty(0, np.int32)))
            yield pa.StructArray.from_arrays([lists, pa.array(plain, pa.string())], ["ids", "decoded_sha256"])

    return text_udf(_streamed(run), "ids array<int>, decoded_sha256 string")(text)


def digests(spark: SparkSession, text: Column, path: str) -> Column:
    """``n_tokens ids_sha256 decoded_sha256`` of a text: encoded with begin and end, then decoded again."""
    shared = spark.sparkContext.broadcast(vocabulary(path))

    def run(batches):
        encoder = Encoder(shared.value)
        for texts in batches:
            counts, coded, plain = [], [], []
            for ids in encoder.encode(texts.to_pylist()):
                whole = _with_ends(encoder.vocab, ids, True)
                counts.append(len(whole))
                coded.append(hashlib.sha256(whole.astype("<u4").tobytes()).hexdigest())
                plain.append(hashlib.sha256(decoded(encoder.vocab, whole).encode("utf-8", "surrogatepass")).hexdigest())
            yield pa.StructArray.from_arrays([pa.array(counts, pa.int64()), pa.array(coded, pa.string()), pa.array(plain, pa.string())], ["n_tokens", "ids_sha256", "decoded_sha256"])

    return text_udf(_streamed(run), "n_tokens long, ids_sha256 string, decoded_sha256 string")(text)


def _streamed(run):
    """``run`` with the type hints that make it an iterator function."""
    from collections.abc import Iterator

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return run
