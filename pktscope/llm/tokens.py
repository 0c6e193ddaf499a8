"""Token ids of whole texts from a tokenizer file of the ``tokenizers`` library.

Words repeat, so a text is cut where a byte-level BPE's pre-tokenizer always
cuts too: in front of a single space between two non-space characters, and on
both sides of a line break (or of each of two) between such.  Each different
piece goes through the library once per Python worker; joined, the pieces' ids
are the ids of the whole text (held against it in the tests).  Texts with other white
space are cut at the single spaces alone, and files of other tokenizers are
given whole texts.
"""

from __future__ import annotations

import itertools
import re

from .common import by_value

by_value(__name__)

VOCABULARY = "byte_bpe_50k.json"
END_ID = 0
_CUT = re.compile(r"(?<=\S)(?= \S)")
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class Encoder:
    """``encode(texts)``: the texts' ids as little-endian unsigned 32-bit
    integers.  ``keep`` bounds the pieces held."""

    def __init__(self, path: str, keep: int = 400_000):
        import os

        import numpy as np
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer, self.keep = Tokenizer.from_file(path), keep
        self.heads: dict[str, bytes] = {}  # pieces as they are
        self.tails: dict[str, bytes] = {}  # pieces with a space in front
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        kind = self.tokenizer.pre_tokenizer
        line = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.cuts = type(kind).__name__ == "ByteLevel" and not kind.add_prefix_space and len(line) == 1
        self.line_id = line[0] if self.cuts else -1
        self.line = self.line_id.to_bytes(4, "little") if self.cuts else b""
        self.spaced = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        if self.cuts:
            mark = self.tokenizer.id_to_token(self.tokenizer.encode(" ", add_special_tokens=False).ids[0])
            self.spaced[[i for t, i in self.tokenizer.get_vocab().items() if t.startswith(mark)]] = True

    def _whole(self, texts: list[str]) -> list[bytes]:
        import numpy as np
        done = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in done]

    def _split(self, pieces: list[str], space: bool):
        """(piece, ids) of pieces without white space, encoded in one go.
        With spaces in front, a piece's first token alone starts with one;
        otherwise a line break, a token of its own there, follows each."""
        import numpy as np
        text = " " + " ".join(pieces) if space else "\n".join(pieces) + "\n"
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        if space:
            starts = np.flatnonzero(self.spaced[ids]).tolist()
            ends = starts[1:] + [len(ids)]
        else:
            ends = np.flatnonzero(ids == self.line_id).tolist()
            starts = [0] + [e + 1 for e in ends[:-1]]
        if len(starts) != len(pieces):
            raise ValueError("a piece's tokens cannot be told from the next one's")
        raw = ids.tobytes()
        return ((p, raw[4 * a:4 * e]) for p, a, e in zip(pieces, starts, ends))

    def _learn(self, known: dict[str, bytes], new: list[str], space: bool) -> dict[str, bytes]:
        """Encode pieces.  Punctuation behind a word's last letter is a token
        of its own, so words and their endings are learned apart; words with
        endings are returned and not kept.  Pieces that are empty or hold white
        space or an added token are left out."""
        made, plain = [], []
        text = "\n".join(new)
        added = [x for x in self.added if x in text]  # nearly always none
        special = {p for p in new if any(x in p for x in added)} if added else ()
        for p in new:
            word = p.rstrip(_MARKS)
            if not word.isalpha() and (p in special or p.split() != [p]):
                continue
            if len(word) < len(p) and word[-1:].isalpha() and p not in special:
                made.append((p, word, p[len(word):]))
            else:
                plain.append(p)
        words = dict.fromkeys([*plain, *(w for _, w, _ in made)])
        endings = {e for _, _, e in made}
        for to, pieces, spaced in ((known, words, space), (self.heads, endings, False)):
            todo = [p for p in pieces if p not in to]
            for k in range(0, len(todo), 4_000):
                to.update(self._split(todo[k:k + 4_000], spaced))
        return {p: known[word] + self.heads[end] for p, word, end in made}

    def _loose(self, text: str) -> bytes:
        """A text with other white space than the quick way takes."""
        first, *rest = _CUT.split(text)
        known = [self.tails.get(p[1:]) for p in rest]
        missing = iter(self._whole([first, *(p for p, k in zip(rest, known) if k is None)]))
        return next(missing) + b"".join(next(missing) if k is None else k for k in known)

    def encode(self, texts, at_once: int = 6_000_000) -> list[bytes]:
        """``texts``: a list or an Arrow array of strings; null is empty."""
        import pyarrow as pa
        import pyarrow.compute as pc
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if not self.cuts:
            return self._whole(texts.to_pylist())
        out, first, held = [], 0, 0
        for i, size in enumerate(pc.binary_length(texts).to_pylist()):
            held += size
            if held >= at_once:
                out += self._encode(texts.slice(first, i + 1 - first))
                first, held = i + 1, 0
        return out + self._encode(texts.slice(first))

    def _encode(self, texts) -> list[bytes]:
        """Split at spaces and line breaks (which become pieces of their own),
        number the different pieces, and lay their ids out by number."""
        import numpy as np
        import pyarrow.compute as pc
        if not len(texts):
            return []
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " \n "), " ")
        coded = split.flatten().dictionary_encode()
        codes, words = coded.indices.to_numpy(), coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        ends = split.offsets.to_numpy()[1:] - split.offsets.to_numpy()[0]
        starts = np.append(0, ends[:-1])
        number = {w: i for i, w in enumerate(words) if w == "" or w == "\n"}
        is_break, is_empty = codes == number.get("\n", -1), codes == number.get("", -1)

        def moved(mask, by):  # mask of the neighbour before (by = 1) or behind (by = -1)
            out = np.zeros(len(mask), bool)
            out[max(by, 0):len(mask) + min(by, 0)] = mask[max(-by, 0):len(mask) - max(by, 0)]
            return out

        head = moved(is_break, 1)
        head[starts] = True
        edge = np.zeros(len(codes), bool)
        edge[starts] = edge[ends - 1] = True
        inner = moved(is_break, 1) & moved(is_break, -1) & ~edge  # an empty line
        odd = is_empty & ~(inner & ~moved(moved(is_empty, 1), 1))

        # ids of the different pieces, at the start of a text or line and
        # behind a space; slot: from a piece's number (heads: plus n) to them
        n = len(words)
        slot, got = np.full(2 * n, -1, np.int64), []
        for known, mask, shift in ((self.heads, head, n), (self.tails, ~head, 0)):
            there = np.zeros(n, bool)
            there[codes[mask]] = True
            numbers = np.flatnonzero(there)
            slot[numbers + shift] = np.arange(len(got), len(got) + len(numbers))
            if len(known) > self.keep:  # early pieces are the frequent ones
                early = dict(itertools.islice(known.items(), self.keep // 2))
                known.clear()
                known.update(early)
            here = list(map(words.__getitem__, numbers.tolist()))
            ids = list(map(known.get, here))
            new = [w for w, x in zip(here, ids) if x is None]
            if new:
                made = self._learn(known, new, not shift)
                ids = [x or known.get(w) or made.get(w) for w, x in zip(here, ids)]
            got += ids
        for w, ids in (("\n", self.line), ("", b"")):
            if w in number:
                for i in slot[[number[w], number[w] + n]].tolist():
                    if i >= 0:
                        got[i] = ids
        unknown = np.array([x is None for x in got], bool)
        got = [x or b"" for x in got] if unknown.any() else got
        sizes = np.fromiter(map(len, got), np.int64, len(got)) // 4
        pool, first = np.frombuffer(b"".join(got), "<u4"), np.cumsum(sizes) - sizes
        of = slot[np.where(head, codes + n, codes)]
        lengths = sizes[of]
        done = np.cumsum(lengths)
        total = int(done[-1])
        ids = pool[np.repeat(first[of] - (done - lengths), lengths) + np.arange(total)].astype("<u4").tobytes()
        cuts = np.append(0, done[ends - 1]).tolist()
        out = [ids[4 * a:4 * b] for a, b in zip(cuts, cuts[1:])]
        again = np.flatnonzero(np.add.reduceat((odd | unknown[of]).astype(np.int64), starts))
        for i in again.tolist():
            text = texts[i].as_py()
            out[i] = self._loose(text) if text else b""
        return out

    def ids(self, text: str | None) -> bytes:
        return self.encode([text])[0]


def worker_encoder(path: str) -> Encoder:
    """The encoder of this Python worker: pieces learned in one task serve the
    next one too."""
    import sys
    import types
    home = sys.modules.setdefault("_pktscope_worker", types.ModuleType("_pktscope_worker"))
    if not hasattr(home, "encoders"):
        home.encoders = {}
    if path not in home.encoders:
        home.encoders[path] = Encoder(path)
    return home.encoders[path]
