"""SentencePiece encoding and decoding of merge-type (BPE) models.

Exact encoding by backtracking. An Aho-Corasick automaton over the model's
pieces lists, for each position, the pieces that begin there. Walking left to
right, the longest piece is taken that is compatible with the piece before it;
two adjacent pieces are compatible when merging their characters anew gives
just these two. A position from which no piece fits is marked in a bitfield of
failed positions, the last piece is taken back, and a shorter one is tried. A
sequence of which all neighbours are compatible is the one that the merges
give. Multi-space runs are the exception: their pieces share one score, so
merges compete by place, and they are merged directly with a heap.

Texts are cut at places that no piece crosses (before a run of spaces, around
line ends, before punctuation; ``cut_pattern`` looks the pieces through); the
ids of a cut are kept in a bounded cache of the worker. Every text is read and encoded whole.

Defined cases: NULL counts as empty, which gives the begin and end ids alone;
characters outside the vocabulary become byte pieces; control strings in a
text are ordinary text; repeated rows give repeated results; extra columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import re
import string

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlake.llm.common import CACHE_WORDS, claim_cache, in_groups

SPACE = "▁"
codecs.register_error("each_byte", lambda e: ("�" * (e.end - e.start), e.end))


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def cut_pattern(pieces) -> re.Pattern:
    """Pattern of the parts of a text that no piece reaches across; the whole text if there are no such places.

    Parts end before spaces, around line ends and between a Latin letter and ASCII punctuation, as far as no piece holds
    these neighbours.
    """
    mark, letter = re.escape(string.punctuation), "A-Za-zÀ-ÖØ-öø-ÿ"
    if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces):
        return re.compile("(?s).+")
    line = "" if any("\n" in p and len(p) > 1 for p in pieces) else "\n"
    parts = [line] if line else []
    if not any(re.search(f"[{letter}][{mark}]", p) for p in pieces):
        parts.append(f"{SPACE}*+[{mark}]*+[{letter}]++(?=[{mark}{SPACE}{line}]|\\Z)")
    return re.compile("|".join([*parts, f"{SPACE}*[^{SPACE}{line}]+", f"{SPACE}+"]))


class Pieces:
    """Encoder and decoder of one model file."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.bos, self.eos, self.unk = sp.bos_id(), sp.eos_id(), sp.unk_id()
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) for i in range(n)]
        names = [sp.id_to_piece(i) for i in range(n)]
        self.id_of = {names[i]: i for i in range(n) if not special[i]}
        self.score = {names[i]: sp.get_score(i) for i in range(n) if not special[i]}
        self.byte_id = {int(names[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        if len(self.byte_id) != 256 or any(sp.is_unused(i) for i in range(n)):
            raise ValueError(f"{path}: a merge-type model with all byte pieces and no unused ones is needed")
        self.dummy = sp.encode("a", out_type=str)[0].startswith(SPACE)
        self.blob = [names[i].replace(SPACE, " ").encode() for i in range(n)]
        for i in range(n):
            if sp.is_control(i):
                self.blob[i] = b""
            elif sp.is_byte(i):
                self.blob[i] = bytes([int(names[i][3:5], 16)])
        self.blob[self.unk] = " ⁇ ".encode()
        self.spaced = {i for i in range(n) if not special[i] and names[i].startswith(SPACE)}
        self.control = {i for i in range(n) if sp.is_control(i)}
        self.longest = max(map(len, self.id_of))
        self.automaton = ahocorasick.Automaton()
        for p in self.id_of:
            self.automaton.add_word(p, len(p))
        self.automaton.make_automaton()
        self.cut = cut_pattern(self.id_of)
        self.known = {c for p in self.id_of if len(p) > 1 for c in p}
        self.fits: dict[tuple[str, str], bool] = {}
        self.whole: dict[str, bool] = {}
        self.cache: dict[str, bytes] = {}

    # --- encoding -------------------------------------------------------

    def merge(self, text: str) -> list[str]:
        """The merges themselves: the best-scored adjacent pair that is a piece, the leftmost of equals, again and again."""
        sym = list(text)
        left, right = list(range(-1, len(sym) - 1)), [*range(1, len(sym)), -1]
        heap: list[tuple[float, int, int, str]] = []

        def offer(a: int, b: int) -> None:
            if a >= 0 and b >= 0 and (joined := sym[a] + sym[b]) in self.score:
                heapq.heappush(heap, (-self.score[joined], a, b, joined))

        for k in range(len(sym) - 1):
            offer(k, k + 1)
        while heap:
            _, a, b, joined = heapq.heappop(heap)
            if not sym[a] or not sym[b] or sym[a] + sym[b] != joined:
                continue
            sym[a], sym[b] = joined, ""
            right[a] = right[b]
            if right[b] >= 0:
                left[right[b]] = a
            offer(left[a], a)
            offer(a, right[a])
        return [s for s in sym if s]

    def reachable(self, piece: str) -> bool:
        if piece not in self.whole:
            self.whole[piece] = self.merge(piece) == [piece]
        return self.whole[piece]

    def compatible(self, a: str, b: str) -> bool:
        got = self.fits.get((a, b))
        if got is None:
            if len(self.fits) > CACHE_WORDS:
                self.fits.clear()
            got = self.fits[a, b] = self.merge(a + b) == [a, b]
        return got

    def walk(self, text: str) -> list[str]:
        """Pieces of a text of vocabulary characters without multi-space runs, by backtracking."""
        n = len(text)
        lengths: list[list[int]] = [[] for _ in range(n)]
        for end, size in self.automaton.iter(text):
            lengths[end + 1 - size].append(size)  # ascending, as the ends ascend
        failed = bytearray((n >> 3) + 1)
        out: list[tuple[str, int]] = []  # pieces and the index of each in its position's list
        pos, k = 0, len(lengths[0]) - 1
        while pos < n:
            options = lengths[pos]
            while k >= 0:
                end = pos + options[k]
                piece = text[pos:end]
                if not failed[end >> 3] >> (end & 7) & 1 and self.reachable(piece) and (not out or self.compatible(out[-1][0], piece)):
                    break
                k -= 1
            if k >= 0:
                out.append((piece, k))
                pos = end
                k = len(lengths[pos]) - 1 if pos < n else 0
            else:
                failed[pos >> 3] |= 1 << (pos & 7)
                piece, k = out.pop()
                pos -= len(piece)
                k -= 1
        return [p for p, _ in out]

    def segment_ids(self, segment: str) -> list[int]:
        """Ids of one cut."""
        if SPACE + SPACE in segment:
            names = self.merge(segment)
        else:
            names, start = [], 0
            for k, c in enumerate(segment):  # characters that no longer piece has stand alone
                if c not in self.known:
                    if k > start:
                        names += self.walk(segment[start:k])
                    names.append(c)
                    start = k + 1
            if start < len(segment):
                names += self.walk(segment[start:])
        out = []
        for p in names:
            i = self.id_of.get(p)
            out += [i] if i is not None else [self.byte_id[b] for b in p.encode()]
        return out

    def encode(self, text: str) -> bytes:
        """All ids with begin and end as little-endian unsigned 32-bit integers."""
        if not text:
            return _le([self.bos, self.eos])
        cuts = self.cut.findall((SPACE if self.dummy else "") + text.replace(" ", SPACE))
        cache = self.cache
        for c in set(cuts).difference(cache):
            cache[c] = _le(self.segment_ids(c))
        out = b"".join([_le([self.bos]), *map(cache.__getitem__, cuts), _le([self.eos])])
        if len(cache) > CACHE_WORDS:
            cache.clear()
        return out

    # --- decoding -------------------------------------------------------

    def decode(self, ids: bytes) -> str:
        """The text of little-endian unsigned 32-bit ids."""
        numbers = memoryview(ids).cast("I").tolist()
        blob = b"".join(map(self.blob.__getitem__, numbers))
        first = next((i for i in numbers if i not in self.control), None)
        if self.dummy and first in self.spaced:
            blob = blob[1:]
        return blob.decode("utf-8", "each_byte")


def _le(ids: list[int]) -> bytes:
    return b"".join([i.to_bytes(4, "little") for i in ids])


_LOADED: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    """The worker's one copy of a model."""
    claim_cache(_LOADED.clear)
    if path not in _LOADED:
        _LOADED[path] = Pieces(path)
    return _LOADED[path]


def encoded(docs: DataFrame, path: str | None = None, keep: tuple[str, ...] = ("ids", "text")) -> DataFrame:
    """doc_id, n_tokens, digests of ids and decoded text, and of ``keep`` the ids (binary, little-endian uint32) and the decoded text."""
    path = path or default_model()

    def rows(batch: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
        model = pieces(path)
        ids = [model.encode(t) for t in texts]
        back = [model.decode(b) for b in ids]
        out = {
            "doc_id": batch.column("doc_id"),
            "n_tokens": pa.array([len(b) // 4 for b in ids], pa.int64()),
            "ids_sha256": pa.array([hashlib.sha256(b).hexdigest() for b in ids], pa.string()),
            "decoded_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in back], pa.string()),
        }
        if "ids" in keep:
            out["ids"] = pa.array(ids, pa.binary())
        if "text" in keep:
            out["decoded"] = pa.array(back, pa.string())
        return pa.RecordBatch.from_pydict(out)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" \
        + (", ids binary" if "ids" in keep else "") + (", decoded string" if "text" in keep else "")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(in_groups(rows, "text"), schema)
