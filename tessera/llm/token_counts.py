"""Token counts with a transducer that is compiled as it meets its input (operator 9).

The vocabulary's merge rule (join the adjacent pair whose joined piece scores highest, leftmost first) has a
local form: a row of pieces is the result exactly if every piece by itself, and every two neighbours by
themselves, come out of the merge rule unchanged. So the last piece of the result of each prefix follows from
the last pieces of a few shorter prefixes: those from which a piece could still reach past the end. These, with
the characters since the first of them and the differences of their token counts, make a state of a
deterministic transducer over characters; each transition carries the number of tokens that it adds (the prefix
that grows may need fewer). The states of a text are finite, as no piece is longer than max_len. States and
transitions are compiled on first use and kept.

A pair of characters that no piece holds cuts all ties: what follows depends on nothing before. Pieces hold a
space only at their beginning, so texts are cut into chunks before spaces. Every chunk's state map then leads
from any state to the same state, and its composition with others, a parallel prefix scan, adds counts: a
cumulative sum over the chunks of a batch, taken apart at the documents' ends. Chunks met before are looked up.
Long chunks are cut further wherever no piece holds the two characters on both sides. What still is long without such
a place is read in segments, whose state maps (from a state to the state behind and the tokens added) are filled in
where they are entered, kept, and composed one after the other.

Defined cases: null reads as the empty text, which has no tokens; very long texts and chunks stream through, and what
is compiled is dropped in the midst of a chunk too, where only the state that it is in goes on. Other columns are not
read, whatever their names; rows of one id are counted each; key columns of any type pass through.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import types as T

SPACE = "▁"
#: Bounds of what a worker keeps: chunks, compiled transitions, checked pairs. Beyond, it is dropped and compiled again.
MAX_CHUNKS, MAX_STEPS, MAX_PAIRS = 400_000, 1_500_000, 1_000_000
#: Longer chunks are cut wherever they can be, and not kept.
MAX_CHUNK = 48
#: Characters of a segment, and state maps' entries that are kept.
SEGMENT, MAX_MAPS = 1024, 2000


class Transducer:
    def __init__(self, scores: dict[str, float]):
        """scores: the pieces that merging may build, single characters included, spaces as ▁."""
        self.scores = scores
        self.max_len = max(map(len, scores))
        self.joined = {p[i : i + 2] for p in scores for i in range(len(p) - 1)}
        if any(x[1] == SPACE != x[0] for x in self.joined):
            raise ValueError("pieces with spaces inside have no chunks to cut at")
        self.begins = {p[:i] for p in scores for i in range(len(p))}
        self.reset()

    def reset(self) -> None:
        self.alone: dict[str, bool] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.states: dict[tuple, int] = {("", ((None, 0),)): 0}
        self.keys: list[tuple] = [("", ((None, 0),))]
        self.steps: list[dict[str, tuple[int, int]]] = [{}]
        self.n_steps = 0
        self.maps: dict[tuple[str, int], tuple[int, int]] = {}

    def number(self, key: tuple) -> int:
        if (to := self.states.get(key)) is None:
            to = self.states[key] = len(self.keys)
            self.keys.append(key)
            self.steps.append({})
        return to

    def restart(self, state: int) -> int:
        """Drop what is compiled, but for the state that the text is in; its new number."""
        key = self.keys[state]
        self.reset()
        return self.number(key)

    def merge(self, text: str) -> list[str]:
        """The merge rule itself, for pieces and pairs of pieces."""
        parts, scores = list(text), self.scores
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = scores.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def whole(self, piece: str) -> bool:
        if (x := self.alone.get(piece)) is None:
            x = self.alone[piece] = piece in self.scores and self.merge(piece) == [piece]
        return x

    def agree(self, a: str | None, b: str) -> bool:
        if a is None or a[-1] + b[0] not in self.joined:
            return True
        if (x := self.pairs.get((a, b))) is None:
            x = self.pairs[a, b] = self.merge(a + b) == [a, b]
        return x

    def compile(self, state: int, c: str) -> tuple[int, int]:
        """The state after c, and the tokens that c adds to the count."""
        since, ends = self.keys[state]
        if c not in self.scores:
            step = (0, len(c.encode("utf-8", "surrogatepass")))
        else:
            # ends[k]: last piece and count (less the count here) of the prefix that ends k characters into `since`
            for k, (last, count) in enumerate(ends):
                piece = since[k:] + c
                if self.whole(piece) and self.agree(last, piece):
                    break
            else:
                raise AssertionError(f"no piece ends with {since + c!r}")
            added = count + 1
            longer = since + c
            first = next(k for k in range(len(longer) + 1) if longer[k:] in self.begins)
            kept = [(last, n - added) for last, n in ends] + [(piece, 0)]
            kept = kept[first:]
            kept = [(None if last and k + first < len(longer) and last[-1] + longer[k + first] not in self.joined else last, n) for k, (last, n) in enumerate(kept)]
            step = (self.number((longer[first:], tuple(kept))), added)
        self.steps[state][c] = step
        self.n_steps += 1
        return step

    def walk(self, state: int, text: str) -> tuple[int, int]:
        """The state behind text, and the tokens that it adds."""
        steps, total = self.steps, 0
        for c in text:
            if (step := steps[state].get(c)) is None:
                if self.n_steps >= MAX_STEPS or len(self.pairs) >= MAX_PAIRS:
                    state = self.restart(state)
                    steps = self.steps
                step = self.compile(state, c)
            state = step[0]
            total += step[1]
        return state, total

    def mapped(self, state: int, segment: str) -> tuple[int, int]:
        """The segment's state map at a state."""
        if (found := self.maps.get((segment, state))) is None:
            maps = self.maps
            found = self.walk(state, segment)
            # a restart on the way has given the states other numbers
            if maps is self.maps:
                if len(maps) >= MAX_MAPS:
                    maps.clear()
                maps[segment, state] = found
        return found

    def cut(self, chunk: str) -> Iterator[str]:
        """Parts of a chunk between which no piece can reach."""
        begin = 0
        for i in range(1, len(chunk)):
            if chunk[i - 1 : i + 1] not in self.joined:
                yield chunk[begin:i]
                begin = i
        yield chunk[begin:]

    def count(self, chunk: str) -> int:
        """Tokens of a chunk that stands at the beginning or behind a cut."""
        if len(chunk) <= SEGMENT:
            return self.walk(0, chunk)[1]
        state, total = 0, 0
        for at in range(0, len(chunk), SEGMENT):
            state, n = self.mapped(state, chunk[at : at + SEGMENT])
            total += n
        return total


class ChunkCounts(dict):
    """Token counts of chunks, by the word behind the chunk's space."""

    def __init__(self, transducer: Transducer):
        super().__init__()
        self.transducer = transducer

    def __missing__(self, word: str) -> int:
        if len(word) > MAX_CHUNK:
            return sum(map(self.transducer.count, self.transducer.cut(SPACE + word)))
        n = self[word] = self.transducer.count(SPACE + word)
        return n


def chunks(text: str) -> list[str]:
    """The words behind each space that begins a chunk; further spaces of a run come first in the word."""
    if SPACE in text:
        text = text.replace(SPACE, " ")
    out = text.split(" ")
    if "" not in out:
        return out
    joined, run = [], 0
    for w in out:
        if w:
            joined.append(SPACE * run + w)
            run = 0
        else:
            run += 1
    if run:
        joined.append(SPACE * (run - 1))
    return joined


def load_pieces(path: str) -> dict[str, float]:
    """Pieces and scores of a BPE model; the rules that the transducer relies on are checked."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    if sp.encode("a  b ﬁ", out_type=str) == sp.encode("a b fi", out_type=str) or not any(sp.is_byte(i) for i in range(n)):
        raise ValueError("only models that keep the text as it is, with byte fallback, are handled")
    return {sp.id_to_piece(i): sp.get_score(i) for i in range(n) if not (sp.is_control(i) or sp.is_byte(i) or sp.is_unknown(i) or sp.is_unused(i))}


_ready: dict[str, ChunkCounts] = {}


def counter(path: str) -> ChunkCounts:
    """This worker's transducer for the model at path."""
    if path not in _ready:
        _ready[path] = ChunkCounts(Transducer(load_pieces(path)))
    return _ready[path]


def count_tokens(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, n_tokens) of every row; model_path must name the same file on every machine."""
    fields = T.StructType([docs.schema[key], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = counter(model_path)
        for b in batches:
            texts = [t or "" for t in b[1].to_pylist()]
            counts, ends = [], [0]
            for t in texts:
                if t:
                    if len(known) > MAX_CHUNKS:
                        known.clear()
                    counts.append(np.fromiter(map(known.__getitem__, words := chunks(t)), np.int64, len(words)))
                ends.append(ends[-1] + (len(counts[-1]) if t else 0))
            scan = np.concatenate(([0], np.cumsum(np.concatenate(counts)))) if counts else np.zeros(1, np.int64)
            at = np.array(ends)
            sizes = pa.compute.binary_length(b[1].cast(pa.binary())).fill_null(0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([b[0], sizes, pa.array(scan[at[1:]] - scan[at[:-1]], pa.int64())], names=fields.names)

    return docs.select(key, text).mapInArrow(run, fields)


def default_model() -> str:
    import public_tokenizers

    return os.fspath(public_tokenizers.path("piece_bpe_32k.model"))
