"""A SentencePiece BPE model read from its file, and linear encoding by a prefix table.

For every prefix of a text the BPE encoding's last token is unique.  The table of
these last tokens is filled from left to right: an automaton over the pieces names
all pieces that end at a position, and the one that belongs there is the piece
whose pair with the last token before it is *compatible*, that is, the two stand
side by side unchanged when their joined text is encoded.  The ids are then read
backwards from the end of the table.

Compatibility follows from the two tokens' own merges: along the inner edge of each
token its successive parts stand at the border, each until the merge that
swallows it.  The pair is compatible if no piece across the border would have been
made before that (the smaller rank first, the left one on ties).

As no piece holds a blank after other characters, and none a line feed, a text may be
cut before blanks and around line feeds, and each cut part (pre-token) encoded alone.
"""

from __future__ import annotations

import re
from array import array
from itertools import islice

import ahocorasick

SPACE = "▁"
NEVER = 1 << 40
#: Bounds of what a Python worker keeps: parts, and characters of a part worth keeping (so at most some 700 bytes each, 300 MB in all; usually a third of that), pairs of pieces.
KEEP, LONG_PART, MAX_PAIRS = 400_000, 64, 1_000_000
_RUNS = re.compile("▁+[^▁]*|[^▁]+")


def pre_tokens(text: str | None) -> list[str]:
    """The parts of a whole text that encode on their own, blanks as ``▁``; some parts may be empty."""
    if not text:
        return []
    text = SPACE + text.replace(" ", SPACE)
    if "▁▁" in text or "\0" in text:
        return _RUNS.findall(text)
    return text.replace(SPACE, "\0▁").replace("\n", "\0\n\0").split("\0")


class PieceModel:
    """The parts of a model file that encoding and decoding need.

    Only BPE models with the identity normaliser, byte fallback and blanks at the
    start of pieces are taken; others are refused.
    """

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        spec = pb.ModelProto()
        with open(path, "rb") as f:
            spec.ParseFromString(f.read())
        t, n = spec.trainer_spec, spec.normalizer_spec
        if t.model_type != t.BPE or n.precompiled_charsmap or n.remove_extra_whitespaces or not n.add_dummy_prefix or not t.byte_fallback:
            raise ValueError("only BPE models with identity normalisation, byte fallback and a dummy prefix are supported")
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        kind = pb.ModelProto.SentencePiece
        order: dict[str, tuple[float, int]] = {}
        self.ids: dict[str, int] = {}
        self.byte_ids = [0] * 256
        self.surface: list[bytes] = []
        self.kept: set[int] = set()  # their leading blank is no dummy
        for i, p in enumerate(spec.pieces):
            if p.type == kind.BYTE:
                value = int(p.piece[1:-1], 16)
                self.byte_ids[value] = i
                self.surface.append(bytes([value]))
            elif p.type == kind.NORMAL:
                self.ids[p.piece] = i
                order[p.piece] = (-p.score, i)
                self.surface.append(p.piece.replace(SPACE, " ").encode())
            elif p.type == kind.UNKNOWN:
                self.kept.add(i)
                self.surface.append(t.unk_surface.encode())
            elif p.type == kind.CONTROL:
                self.surface.append(b"")
            else:
                raise ValueError(f"pieces of type {p.type} are not supported")
        self.kept.update(self.byte_ids)
        if any(SPACE in p.lstrip(SPACE) or p.startswith("▁▁") and p.strip(SPACE) or "\n" in p for p in self.ids):
            raise ValueError("a piece holds a blank after other characters, or a line feed")
        runs = {p for p in order if len(p) > 1 and not p.strip(SPACE)}
        self.runs = {len(p): self.ids[p] for p in runs}
        words = sorted((p for p in order if len(p) > 1 and p not in runs), key=order.__getitem__)
        if runs and (len({order[p][0] for p in runs}) > 1 or words and order[words[-1]][0] >= min(order[p][0] for p in runs)):
            raise ValueError("runs of blanks must share a score below all other pieces")
        self.rank = {p: k for k, p in enumerate(words)}
        self.halves: dict[str, tuple[str, str] | None] = {}
        self.left: dict[str, list[tuple[str, int]]] = {}
        self.right: dict[str, list[tuple[str, int]]] = {}
        self.fits: dict[str, dict[str, bool]] = {}
        self.pairs = 0
        self.automaton = ahocorasick.Automaton()
        for p in self.ids:
            if p not in runs and (len(p) == 1 or self._last_merge(p)):
                self.automaton.add_word(p, (len(p), p))
        self.automaton.make_automaton()

    def _last_merge(self, piece: str) -> tuple[str, str] | None:
        """The two parts that BPE joins last when it makes the piece; None if it never makes it."""
        if piece not in self.halves:
            parts, last = list(piece), None
            while len(parts) > 1:
                rank, at = min((self.rank.get(parts[k] + parts[k + 1], NEVER), k) for k in range(len(parts) - 1))
                if rank == NEVER:
                    last = None
                    break
                last = (parts[at], parts[at + 1])
                parts[at : at + 2] = ["".join(last)]
            self.halves[piece] = last
        return self.halves[piece]

    def _edge(self, piece: str, side: int) -> list[tuple[str, int]]:
        """(part, rank of the merge that swallows it) for the parts that stand at one edge of the piece, in time."""
        known = (self.left, self.right)[side]
        if piece not in known:
            parts, at = [(piece, NEVER)], piece
            while len(at) > 1:
                whole, at = at, self._last_merge(at)[side]
                parts.append((at, self.rank[whole]))
            known[piece] = parts[::-1]
        return known[piece]

    def compatible(self, a: str, b: str) -> bool:
        """Whether the pieces a and b stand side by side in the encoding of their joined text."""
        left, right, rank = self._edge(a, 1), self._edge(b, 0), self.rank
        i = j = 0
        while True:
            (x, ends_x), (y, ends_y) = left[i], right[j]
            made = rank.get(x + y, NEVER)
            if made < ends_x and made <= ends_y and made != NEVER:
                return False
            if ends_x == ends_y == NEVER:
                return True
            if ends_x <= ends_y:
                i += 1
            else:
                j += 1

    def _blanks(self, count: int) -> list[int]:
        """The ids of a run of blanks: of equal scores the leftmost pair joins first, after all other merges."""
        done: list[int] = []
        for _ in range(count):
            if done and done[-1] + 1 in self.runs:
                done[-1] += 1
            else:
                done.append(1)
            while len(done) > 1 and done[-2] + done[-1] in self.runs:
                done[-2:] = [done[-2] + done[-1]]
        return [self.runs[k] if k > 1 else self.ids[SPACE] for k in done]

    def encode_part(self, text: str) -> list[int]:
        """The ids of one pre-token, by its prefix table; a run of blanks at its start only joins after all else."""
        if text[:2] == "▁▁":
            rest = text.lstrip(SPACE)
            blanks = len(text) - len(rest)
            tail = self._table(SPACE + rest) if rest else []
            if tail[:1] == [self.ids[SPACE]] or not rest:
                return self._blanks(blanks) + tail[1:]
            return self._blanks(blanks - 1) + tail
        return self._table(text)

    def _table(self, text: str) -> list[int]:
        n = len(text)
        last: list[str | None] = [None] * (n + 1)
        if self.pairs > MAX_PAIRS:
            self.fits, self.pairs = {}, 0
        fits = self.fits
        for end, (size, piece) in self.automaton.iter(text):
            end += 1
            if last[end] is None:
                before = last[end - size]
                if before is None:  # the start, or a character outside the vocabulary, which joins nothing
                    last[end] = piece
                    continue
                known = fits.get(before)
                if known is None:
                    known = fits[before] = {}
                ok = known.get(piece)
                if ok is None:
                    ok = known[piece] = self.compatible(before, piece)
                    self.pairs += 1
                if ok:
                    last[end] = piece
        out, ids = [], self.ids
        while n:
            piece = last[n]
            if piece is None:
                out.extend(self.byte_ids[x] for x in reversed(text[n - 1].encode("utf-8", "surrogatepass")))
                n -= 1
            else:
                out.append(ids[piece])
                n -= len(piece)
        return out[::-1]

    def decode(self, ids: list[int]) -> str:
        """The library's text for ids: blanks restored, the dummy one dropped, bad bytes replaced one by one."""
        parts = list(map(self.surface.__getitem__, ids))
        for k, x in enumerate(parts):  # the dummy blank goes from the first piece that has a surface
            if x:
                if x[:1] == b" " and ids[k] not in self.kept:
                    parts[k] = x[1:]
                break
        whole = b"".join(parts)
        try:
            return whole.decode()
        except UnicodeDecodeError:
            return self.library.decode(ids)



_MODELS: dict[str, PieceModel] = {}


def model(path: str) -> PieceModel:
    """The model of a path, loaded once in each Python worker."""
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def older_half(cache: dict) -> dict:
    """The older half of a full cache, where the frequent parts are."""
    return dict(islice(cache.items(), len(cache) // 2))


class PieceEncoder:
    """Encodes whole texts; keeps the int32 ids of up to ``keep`` pre-tokens it has met."""

    def __init__(self, path: str, keep: int = KEEP):
        self.model, self.keep, self.known = model(path), keep, {"": b""}

    def _learn(self, part: str) -> bytes:
        ids = array("i", self.model.encode_part(part)).tobytes()
        if len(part) <= LONG_PART:
            if len(self.known) >= self.keep:
                self.known = older_half(self.known)
            self.known[part] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        """Native (little-endian) int32 ids of a whole text."""
        parts = pre_tokens(text)
        ids = list(map(self.known.get, parts))
        if None in ids:
            for k, x in enumerate(ids):
                if x is None:
                    x = self.known.get(parts[k])
                    ids[k] = self._learn(parts[k]) if x is None else x
        return b"".join(ids)
