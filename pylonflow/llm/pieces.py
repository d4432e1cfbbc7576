"""Merge-type piece encoding by a prefix table, and decoding.

A merge-type (BPE) vocabulary splits a text by merging neighbours, best score
first, leftmost among equals. The split of a prefix is a prefix of the split
of the text up to its last token, so that every prefix has one last token. An
automaton of all pieces finds, in one walk over the text, the pieces that end
at each character; the one that may follow the last token of what stands
before it is the prefix's last token, and the ids are read off backwards from
the end. The walk is linear, whatever the length of a word.

Two tokens may stand side by side if their joint text splits into just the
two. For that, no merge may cross the border while both sides grow: the
symbols at the border are one's right edge and the other's left edge, each
alive from the merge that makes it to the merge that takes it up. A crossing
merge that could happen while both its sides are alive forbids the pair. Where
turns are no order in time (scores that pieces share, a piece scored before
its parts) the pair's text is split by plain merging. Answers are kept by pair.

No piece has the space mark behind another character, so that words can be
split one by one; each task keeps the words it has met, up to a bound.

Nothing is shuffled: rows are independent, texts are cut into bounded windows
inside a task, and a lost executor costs its rows alone. Null and empty texts
have no ids; null ids decode to the empty text.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pylonflow.llm.common import documents
from pylonflow.llm.decontaminate import _slices
from pylonflow.session import ship_package

MARK = "▁"            # stands for a space
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6     # kinds of pieces in the model file
WINDOW = 1 << 20           # characters split at a time
KEPT_WORDS, KEPT_PAIRS = 200_000, 500_000     # what a task remembers
SHORT = 48                 # longest word whose table is filled together with others'
NEVER = 1 << 60


class Vocabulary:
    """What encoding and decoding need of a model file: pieces with turns, their last merges and the pairs that merge.

    ``turn`` numbers the scores from the best; a single character is there from the start (turn -1).
    """

    def __init__(self, pieces: list[str], scores: list[float], kinds: list[int], dummy_prefix: bool):
        self.pieces, self.kinds, self.dummy_prefix = pieces, kinds, dummy_prefix
        self.ids = {p: k for k, (p, kind) in enumerate(zip(pieces, kinds, strict=True)) if kind == NORMAL}
        order = {s: k for k, s in enumerate(sorted({scores[k] for p, k in self.ids.items() if len(p) > 1}, reverse=True))}
        self.turn = {k: order[scores[k]] if len(p) > 1 else -1 for p, k in self.ids.items()}
        self.bytes = {int(p[1:-1], 16): k for k, (p, kind) in enumerate(zip(pieces, kinds, strict=True)) if kind == BYTE}
        self.words = all(MARK not in p.lstrip(MARK) for p in self.ids)
        self.merges: dict[tuple[int, int], int] = {}
        for p, k in self.ids.items():
            for cut in range(1, len(p)):
                a, b = self.ids.get(p[:cut]), self.ids.get(p[cut:])
                if a is not None and b is not None:
                    self.merges[a, b] = k
        self.parts: dict[int, tuple[int, int]] = {}
        self.whole = set()      # pieces that their own text splits into
        for p, k in sorted(self.ids.items(), key=lambda x: len(x[0])):
            got = self.merged(p, self.parts)
            if got == [k]:
                self.whole.add(k)
        self.right = {k: self._edge(k, 1) for k in self.whole}
        self.left = {k: self._edge(k, 0) for k in self.whole}
        # pieces that grow in turn: no merge on the way has the turn of another piece or comes before its parts' merges
        shared = Counter(self.turn.values())
        self.plain: set[int] = set()
        for k in sorted(self.whole, key=lambda k: len(pieces[k])):
            a, b = self.parts.get(k, (k, k))
            if a == k or (shared[self.turn[k]] == 1 and {a, b} <= self.plain and max(self.turn[a], self.turn[b]) < self.turn[k]):
                self.plain.add(k)

    def _edge(self, k: int, side: int) -> list[tuple[int, int]]:
        """(symbol, turn of the merge that takes it up) along one edge of a piece, the piece first."""
        out, until = [], NEVER
        while True:
            out.append((k, until))
            if k not in self.parts:
                return out
            until, k = self.turn[k], self.parts[k][side]

    def merged(self, text: str, made: dict | None = None) -> list[int]:
        """Plain merging of a short text of known characters: best turn first, leftmost among equals."""
        ids = [self.ids.get(c, -1) for c in text]
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap = [(self.turn[m], i, ids[i], ids[i + 1]) for i in range(len(ids) - 1)
                if (m := self.merges.get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= len(ids) or ids[j] != b:
                continue
            k = self.merges[a, b]
            if made is not None and i == 0 and len(self.pieces[k]) == len(text):
                made[k] = (a, b)
            ids[i], ids[j] = k, None
            after[i] = after[j]
            if after[j] < len(ids):
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < len(ids) and (m := self.merges.get((ids[x], ids[y]))) is not None:
                    heapq.heappush(heap, (self.turn[m], x, ids[x], ids[y]))
        return [k for k in ids if k is not None]

    def fits(self, a: int, b: int) -> bool:
        """Whether token ``b`` may follow token ``a``."""
        if a not in self.plain or b not in self.plain:
            return self.merged(self.pieces[a] + self.pieces[b]) == [a, b]
        for x, x_until in self.right[a]:
            for y, y_until in self.left[b]:
                m = self.merges.get((x, y))
                if m is None:
                    continue
                # a merge waits for both its sides; of equal turns the left one is first: inside ``a`` before, inside ``b`` after
                at = max(self.turn[m], self.turn[x], self.turn[y])
                if at < x_until and at <= y_until:
                    return False
        return True


@lru_cache(maxsize=2)
def read_vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a merge-type model file; other kinds of models are refused."""
    from sentencepiece import sentencepiece_model_pb2 as model
    m = model.ModelProto()
    with open(path, "rb") as f:     # the driver's own copy; what tasks need of it is broadcast
        m.ParseFromString(f.read())
    rules = m.normalizer_spec
    if m.trainer_spec.model_type != model.TrainerSpec.BPE or not m.trainer_spec.byte_fallback:
        raise ValueError("only merge-type models with byte fallback are supported")
    if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces \
            or m.trainer_spec.treat_whitespace_as_suffix:
        raise ValueError("only models that leave texts as they are, but for the space mark, are supported")
    kinds = [p.type for p in m.pieces]
    if set(kinds) - {NORMAL, UNKNOWN, CONTROL, BYTE}:
        raise ValueError("user-defined and unused pieces are not supported")
    return Vocabulary([p.piece for p in m.pieces], [p.score for p in m.pieces], kinds, rules.add_dummy_prefix)


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


class Encoder:
    """A task's prefix tables: automaton, remembered pairs and words.

    Short words not met before get their tables together, one array step a place in the word; long words, and words
    with characters outside the vocabulary, one by one.
    """

    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick
        self.v = v = vocabulary
        self.automaton = ahocorasick.Automaton()
        for k in v.whole:
            self.automaton.add_word(v.pieces[k], k)
        self.automaton.make_automaton()
        self.known = {p for p in v.ids if len(p) == 1}
        self.length = [len(p) for p in v.pieces]
        self.lengths = np.array(self.length, np.int64)
        self._plant()
        self.pairs: dict[int, bool] = {}
        self.recent = np.full(1 << 20, -1, np.int64)      # pair and answer by a hash of the pair, the last one met
        lone = re.escape("".join(chr(c) for c in range(128) if chr(c) not in self.known and c != 32))    # in no piece: words by themselves
        self.find = re.compile(f"[{lone}]|{MARK}*[^{MARK}{lone}]+|{MARK}+" if v.words and lone else
                               f"{MARK}*[^{MARK}]+|{MARK}+" if v.words else r"(?s).+").findall
        self.border = re.compile(f"(?<!{MARK}){MARK}")
        self._forget()

    def _forget(self) -> None:
        self.at: dict[str, int] = {}
        self.pool, self.starts = array("i"), array("q", [0])

    def _plant(self) -> None:
        """The pieces as a tree in a hash table: (node, character class) to the node below, and the piece a node ends."""
        v, tree, ends = self.v, {}, [-1]
        self.classes = np.zeros(0x110000, np.int32)     # 0: in no piece
        for c, p in enumerate(sorted(self.known), 1):
            self.classes[ord(p)] = c
        self.width = len(self.known) + 1
        for k in v.whole:
            node = 0
            for c in v.pieces[k]:
                key = node * self.width + int(self.classes[ord(c)])
                if key not in tree:
                    tree[key] = len(ends)
                    ends.append(-1)
                node = tree[key]
            ends[node] = k
        self.ends = np.array(ends, np.int64)
        size = 1 << (4 * len(tree)).bit_length()
        self.keys, self.below = np.full(size, -1, np.int64), np.zeros(size, np.int64)
        keys, below = np.fromiter(tree.keys(), np.int64, len(tree)), np.fromiter(tree.values(), np.int64, len(tree))
        slot = self._slot(keys)
        while len(keys):     # the first of those that want a free slot gets it, the others try the next one
            _, first = np.unique(slot, return_index=True)
            first = first[self.keys[slot[first]] == -1]
            self.keys[slot[first]], self.below[slot[first]] = keys[first], below[first]
            rest = np.ones(len(keys), bool)
            rest[first] = False
            keys, below, slot = keys[rest], below[rest], (slot[rest] + 1) & (size - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * 0x9E3779B1 >> 9) & (len(self.keys) - 1)

    def _down(self, node: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """The nodes below, 0 where there is none."""
        keys = node * self.width + classes
        slot = self._slot(keys)
        there = self.keys[slot]
        out = np.where(there == keys, self.below[slot], 0)
        away = np.flatnonzero((there != keys) & (there != -1))
        while len(away):
            slot[away] = (slot[away] + 1) & (len(self.keys) - 1)
            there = self.keys[slot[away]]
            out[away] = np.where(there == keys[away], self.below[slot[away]], 0)
            away = away[(there != keys[away]) & (there != -1)]
        return out

    def _matches(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(place of the first character, piece) of all pieces in the text, walked down from every place at once."""
        classes = self.classes[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
        at, node, starts, pieces, depth = np.arange(len(classes)), np.zeros(len(classes), np.int64), [], [], 0
        while len(at):
            node = self._down(node, classes[at + depth])
            on = np.flatnonzero(node)
            at, node = at[on], node[on]
            piece = self.ends[node]
            hit = np.flatnonzero(piece >= 0)
            starts.append(at[hit])
            pieces.append(piece[hit])
            depth += 1      # the text ends with a character of no piece: no walk leaves it
        return np.concatenate(starts), np.concatenate(pieces)

    def _fit(self, pair: int) -> bool:
        ok = self.pairs.get(pair)
        if ok is None:
            if len(self.pairs) >= KEPT_PAIRS:
                self.pairs.clear()
            ok = self.pairs[pair] = self.v.fits(*divmod(pair, len(self.length)))
        return ok

    def _fits(self, pairs: np.ndarray) -> np.ndarray:
        slot = (pairs * 0x9E3779B1 >> 7) & (len(self.recent) - 1)
        got = self.recent[slot]
        ok, away = (got & 1).astype(bool), np.flatnonzero(got >> 1 != pairs)
        if len(away):
            new, place = np.unique(pairs[away], return_inverse=True)
            answers = np.fromiter(map(self._fit, new.tolist()), bool, len(new))[place]
            ok[away] = answers
            self.recent[slot[away]] = pairs[away] << 1 | answers
        return ok

    def last_tokens(self, run: str) -> array:
        """Every prefix's last token; -1 where the last character is in no piece."""
        last, none = array("i", [-2]) * len(run), -2
        if not self.known.issuperset(run):
            for k, c in enumerate(run):
                if c not in self.known:
                    last[k] = -1
        length, fit, n = self.length, self._fit, len(self.length)
        for end, piece in self.automaton.iter(run):
            if last[end] != none:
                continue
            start = end - length[piece]
            if start >= 0 and (before := last[start]) != -1 and (before == none or not fit(before * n + piece)):
                continue
            last[end] = piece
        return last

    def split(self, run: str) -> list[int]:
        last, k, out = self.last_tokens(run), len(run) - 1, []
        while k >= 0:
            t = last[k]
            if t == -1:
                out.extend(self.v.bytes[b] for b in reversed(run[k].encode()))
                k -= 1
            elif t < 0:
                raise AssertionError(f"no token ends at {k}")
            else:
                out.append(t)
                k -= self.length[t]
        out.reverse()
        return out

    def _split_together(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids one word after the other, ids a word) of short words of known characters."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1) - 1     # a character that no text has stands behind each word
        place, piece = self._matches("\ud800".join([*words, ""]))
        end = place + self.lengths[piece] - 1
        first = np.repeat(ends - sizes, sizes + 1)[place]
        order = np.argsort((end - first).astype(np.int16), kind="stable")
        end, piece, first, start = end[order], piece[order], first[order], place[order] - 1
        last = np.full(int(ends[-1]) + 1, -2, np.int64)
        steps = np.searchsorted(end - first, np.arange(int(sizes.max()) + 1))
        for lo, hi in zip(steps[:-1], steps[1:], strict=True):
            whole = start[lo:hi] < first[lo:hi]      # from the word's first character on
            before = np.where(whole, -1, last[start[lo:hi]])
            ok, asked = whole, np.flatnonzero(before >= 0)
            ok[asked] = self._fits(before[asked] * len(self.length) + piece[lo:hi][asked])
            last[end[lo:hi][ok]] = piece[lo:hi][ok]
        at, word, back = ends - 1, np.arange(len(words)), []
        while len(word):
            token = last[at]
            back.append((word, token))
            at = at - self.lengths[token]
            more = at >= (ends - sizes)[word]
            at, word = at[more], word[more]
        counts = np.bincount(np.concatenate([w for w, _ in back]), minlength=len(words))
        upto, ids = np.cumsum(counts), np.empty(int(counts.sum()), np.int32)
        for k, (word, token) in enumerate(back):
            ids[upto[word] - 1 - k] = token
        return ids, counts

    def _learn(self, words: list[str]) -> None:
        known, together, alone = self.known.issuperset, [], []
        for w in words:
            (together if len(w) <= SHORT and known(w) else alone).append(w)
        at = len(self.starts) - 1
        for k in range(0, len(together), 1 << 16):
            ids, counts = self._split_together(together[k:k + (1 << 16)])
            self.starts.frombytes((len(self.pool) + np.cumsum(counts)).astype(np.int64).tobytes())
            self.pool.frombytes(ids.tobytes())
        for w in alone:
            self.pool.extend(self.split(w))
            self.starts.append(len(self.pool))
        self.at.update(zip(together + alone, range(at, len(self.starts)), strict=False))

    def _windows(self, text: str) -> Iterator[str]:
        text, lo = (MARK if self.v.dummy_prefix else "") + text.replace(" ", MARK), 0
        while len(text) - lo > WINDOW and self.v.words and (cut := self.border.search(text, lo + WINDOW)):
            yield text[lo:cut.start()]
            lo = cut.start()
        yield text[lo:] if lo else text

    def _group(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids a word) of words in order."""
        if len(self.at) >= KEPT_WORDS or len(self.pool) >= 16 * KEPT_WORDS:
            self._forget()
        if new := set(words).difference(self.at):
            self._learn(list(new))
        at = np.fromiter(map(self.at.__getitem__, words), np.int64, len(words))
        starts = np.frombuffer(self.starts, np.int64)
        first, sizes = starts[at], starts[at + 1] - starts[at]
        ends = np.cumsum(sizes)
        return np.frombuffer(self.pool, np.int32)[np.repeat(first - ends + sizes, sizes) + np.arange(ends[-1])], sizes

    def encode_all(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids one text after the other, ids a text)."""
        counts, out = np.zeros(len(texts), np.int64), []
        words, owners, waiting = [], [], 0

        def flush():
            nonlocal words, owners, waiting
            if words:
                ids, sizes = self._group(words)
                out.append(ids)
                np.add.at(counts, [k for k, _ in owners], np.add.reduceat(sizes, np.cumsum([0, *[n for _, n in owners]])[:-1]))
            words, owners, waiting = [], [], 0

        for k, text in enumerate(texts):
            for window in self._windows(text) if text else ():
                got = self.find(window)
                words += got
                owners.append((k, len(got)))
                waiting += len(window)
                if waiting >= WINDOW:
                    flush()
        flush()
        return np.concatenate(out) if out else np.zeros(0, np.int32), counts


class Decoder:
    """Texts of id lists: pieces joined, space marks as spaces, the first one dropped, byte runs read as UTF-8."""

    def __init__(self, vocabulary: Vocabulary):
        v = vocabulary
        number = {k: b for b, k in v.bytes.items()}
        self.surfaces = [bytes([number[k]]) if kind == BYTE else b"" if kind == CONTROL else " ⁇ ".encode() if kind == UNKNOWN
                         else p.replace(MARK, " ").encode() for k, (p, kind) in enumerate(zip(v.pieces, v.kinds, strict=True))]
        # behind them, the surfaces without their first space: what a piece that opens a text is read as
        self.table = pa.array([*self.surfaces, *[x.removeprefix(b" ") for x in self.surfaces]], pa.large_binary())
        self.lead = np.array([v.dummy_prefix and kind == NORMAL and p.startswith(MARK) for p, kind in zip(v.pieces, v.kinds, strict=True)])
        self.control = np.array([kind == CONTROL for kind in v.kinds])

    def decode(self, offsets: np.ndarray, ids: np.ndarray) -> pa.Array:
        """Text of each list ``ids[offsets[k]:offsets[k + 1]]``."""
        if len(ids) and not 0 <= ids.min() <= ids.max() < len(self.surfaces):
            raise ValueError("an id is outside the vocabulary")
        first = offsets[:-1].copy()
        if (control := self.control[ids]).any():
            for k in np.flatnonzero(np.diff(offsets)):
                while first[k] < offsets[k + 1] and control[first[k]]:
                    first[k] += 1
        first = first[first < offsets[1:]]
        opening = np.zeros(len(ids), bool)
        opening[first] = self.lead[ids[first]]
        ids = ids + opening * len(self.surfaces)
        whole = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), self.table.take(pa.array(ids, pa.int64()))),
                               pa.scalar(b"", pa.large_binary()))
        try:
            if not control.any():
                return whole.cast(pa.large_string())
        except pa.ArrowInvalid:     # some byte run is no UTF-8
            pass
        return pa.array([self._with_marks(ids[lo:hi], control[lo:hi]) for lo, hi in zip(offsets[:-1], offsets[1:], strict=True)],
                        pa.large_string())

    def _with_marks(self, ids: np.ndarray, control: np.ndarray) -> str:
        """Every byte that belongs to no character becomes U+FFFD, one by one; a control id ends a byte run."""
        out, lo = [], 0
        for hi in [*np.flatnonzero(control), len(ids)]:
            rest, lo = b"".join(self.table[int(k)].as_py() for k in ids[lo:hi]), hi
            while rest:
                try:
                    out.append(rest.decode())
                    break
                except UnicodeDecodeError as e:
                    out.append(rest[:e.start].decode() + "\ufffd")
                    rest = rest[e.start + 1:]
        return "".join(out)


_MADE: dict = {}


def _tool(kind: type, name: str, sent):
    """One encoder or decoder a Python worker, kept from task to task."""
    if (kind, name) not in _MADE:
        _MADE.clear()
        _MADE[kind, name] = kind(sent.value)
    return _MADE[kind, name]


def _map(df: DataFrame, column: str, out: str, kind: str, work, keep: list[str], model: str | None) -> DataFrame:
    spark = df.sparkSession
    ship_package(spark)
    path = model or default_model()
    sent = spark.sparkContext.broadcast(read_vocabulary(path))   # bounded by the vocabulary: a few MB
    fields = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep]
    rows = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{column}`").alias("_work"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield from (pa.RecordBatch.from_arrays(columns, names=[*keep, out]) for columns in work(path, sent, b))

    return rows.mapInArrow(run, ", ".join([*fields, f"`{out}` {kind}"]))


def _encoded(path: str, sent, b: pa.RecordBatch) -> Iterator[list[pa.Array]]:
    enc, last = _tool(Encoder, path, sent), b.num_columns - 1
    for lo, hi in _slices(b.column(last), 4 << 20):
        ids, counts = enc.encode_all(b.column(last).slice(lo, hi - lo).to_pylist())
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(ids))
        yield [*[b.column(k).slice(lo, hi - lo) for k in range(last)], lists]


def _decoded(path: str, sent, b: pa.RecordBatch) -> Iterator[list[pa.Array]]:
    dec, last = _tool(Decoder, path, sent), b.num_columns - 1
    for lo in range(0, b.num_rows, 512):
        part = b.slice(lo, 512)
        lists = part.column(last)
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        texts = dec.decode(np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]), pc.fill_null(lists.flatten(), -1).to_numpy(zero_copy_only=False))
        yield [*[part.column(k) for k in range(last)], texts.cast(pa.string())]


def encode(df: DataFrame, text: str = "text", out: str = "ids", keep: list[str] | None = None, model: str | None = None) -> DataFrame:
    """Columns ``keep`` (all others by default) and ``out``: the ids of every whole text, without begin or end ids.

    One row a row, repeated ones included. Null and empty texts have an empty list.
    """
    return _map(df, text, out, "array<int>", _encoded, [c for c in df.columns if c != text] if keep is None else keep, model)


def decode(df: DataFrame, ids: str = "ids", out: str = "text", keep: list[str] | None = None, model: str | None = None) -> DataFrame:
    """Columns ``keep`` (all others by default) and ``out``: the text of every id list; null or empty: the empty text.

    An id that the vocabulary lacks (or a null one) is an error.
    """
    return _map(df, ids, out, "string", _decoded, [c for c in df.columns if c != ids] if keep is None else keep, model)


def op11_piece_encoding(spark, sf_dir: str) -> DataFrame:
    """Every document's ids and their text again, as digests. Null texts count as empty."""
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    ids = encode(documents(spark, sf_dir).select("doc_id", "text"), keep=["doc_id"])
    rows = ids.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      sha(F.concat_ws(",", F.col("ids").cast("array<string>"))).alias("ids_sha256"), "ids")
    back = decode(rows, keep=["doc_id", "n_tokens", "ids_sha256"])
    return back.select("doc_id", "n_tokens", "ids_sha256", sha(F.col("text")).alias("decoded_sha256"))
