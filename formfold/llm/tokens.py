"""Ids of whole texts through the tokenizers library, each distinct piece encoded once.

The library splits a text where a space stands between two characters that are not white
space: such a space always begins a new word.  So a text cut at these spaces has the ids of
its pieces, one after the other, and a piece's ids can be remembered.  A text in which white
space touches a space is encoded as one piece.

New pieces are put together from parts the library splits apart too: a line's end between two
characters that are not white space, a run of letters, the marks after it.  Many words of letters
go to the library's model in one line, which does not split them again: no entry of the
vocabulary joins a letter with the space or line's end after it, so no merge crosses into the next word.
"""

from __future__ import annotations

import gc
import os
import re
from array import array
from functools import lru_cache
from string import punctuation

import numpy as np

#: White space other than the space itself.
OTHER_SPACES = [c for c in map(chr, range(0x3001)) if c.isspace() and c != " "]
#: Up to here all libraries agree what a letter is.
LATIN_END = "\u0250"
#: Pieces that are encoded in one call.
LINES = 64
#: Texts that are looked up together: their pieces stay in the processor's cache.
TEXTS = 64
#: Words of letters that go to the model in one line.
WORDS = 16
#: Ends of words that are remembered.
ENDS = 10_000
#: How a byte-level vocabulary spells the bytes that do not stand for themselves.
SPELT = {b: chr(256 + i) for i, b in enumerate([*range(0x21), *range(0x7F, 0xA1), 0xAD])}
ASCII_SPACES = [c for c in OTHER_SPACES if c < "\x80"]


def pieces_of(text: str) -> list[str]:
    for c in ASCII_SPACES if text.isascii() else OTHER_SPACES:
        if c in text and (" " + c in text or c + " " in text):
            return [text]
    pieces = text.split(" ")
    return [text] if "" in pieces else pieces


class Memory(dict):
    """Piece to bytes; of at most `most` entries a half that was not asked for lately goes."""

    def __init__(self, most: int):
        super().__init__()
        self.half, self.older = most // 2, {}

    def trim(self) -> None:
        if len(self) > self.half:
            self.older = dict(self)
            self.clear()

    def recall(self, pieces: set[str]) -> list[str]:
        """The pieces that are really new; the others are fetched from the older half."""
        older, new = self.older, []
        for p in pieces:
            found = older.get(p)
            if found is None:
                new.append(p)
            else:
                self[p] = found
        return new


class Encoder:
    """encode(texts) gives each text's ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, remembered: int = 1_600_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.first, self.later = Memory(remembered // 8), Memory(remembered)
        # a line's end before a space is a word of its own: one id between two pieces
        ends = self.tokenizer.encode("a\n b", add_special_tokens=False).ids
        self.end = ends[len(ends) // 2] if len(ends) == 3 else None
        self.tails: dict[str, bytes] = {}
        self.line_end = np.array(ends[1:2], np.uint32).tobytes()
        self.model, self.begins = self.unsplit(path)

    def unsplit(self, path: str):
        """The same vocabulary without the split into words, and by lead which ids begin with it; no leads where
        the file differs from a plain byte-level one, or has an entry of letters that goes on beyond them."""
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, WhitespaceSplit
        plain = self.tokenizer
        named = re.search(r"ByteLevel\(add_prefix_space=False, trim_offsets=\w+, use_regex=True\)", repr(plain.pre_tokenizer))
        if not isinstance(plain.pre_tokenizer, ByteLevel) or not named or plain.normalizer is not None or plain.post_processor is not None:
            return plain, {}
        model = Tokenizer.from_file(path)
        model.encode_special_tokens = True
        model.pre_tokenizer = WhitespaceSplit()
        vocabulary, begins = model.get_vocab(with_added_tokens=False), {}
        no_break = "\xc2" + SPELT[0xA0]  # in no word of letters
        if self.end is None:
            return model, {}
        space, end = SPELT[32], SPELT[10]
        for lead, beyond in ((" ", f"[^{space}]{space}"), ("\n", f"[^{end}]{end}|{end}[^{end}{space}]")):
            if not any(re.search(beyond, t) and no_break not in t for t in vocabulary):
                begins[lead] = np.zeros(max(vocabulary.values()) + 1, bool)
                begins[lead][[i for t, i in vocabulary.items() if t[0] == SPELT[ord(lead)]]] = True
        return model, begins

    def whole(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def words(self, words: list[str], lead: str) -> list[bytes]:
        """The ids of words of letters, each after the lead, the lead's own id left out if it is a line's end."""
        lines = [lead + lead.join(words[k:k + WORDS]) for k in range(0, len(words), WORDS)]
        lines = [x.replace(lead, SPELT[ord(lead)]) if x.isascii() else x.encode().decode("latin-1").translate(SPELT) for x in lines]
        ids: list[int] = []
        for e in self.model.encode_batch_fast(lines, add_special_tokens=False):
            ids += e.ids
        coded = np.array(ids, np.uint32)
        starts = np.flatnonzero(self.begins[lead][coded])
        if len(starts) != len(words):
            raise ValueError("the vocabulary joins words")
        data, stops = coded.tobytes(), [*(4 * starts[1:]).tolist(), 4 * len(coded)]
        return [data[a:b] for a, b in zip((4 * starts + 4 * (lead == "\n")).tolist(), stops)]

    def spaced(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece after a space.  Pieces go in lines together, which costs less than a call
        each, and are parted at the ids of the line ends; those with white space of their own go alone."""
        alone = [" " + p for p in pieces]
        if self.end is None:
            return self.whole(alone)
        out: list[bytes | None] = [None] * len(pieces)
        plain = [i for i, p in enumerate(pieces) if p.split() == [p]]
        runs = [plain[k:k + LINES] for k in range(0, len(plain), LINES)]
        made = self.tokenizer.encode_batch_fast(["\n".join([alone[i] for i in run]) for run in runs], add_special_tokens=False)
        for run, e in zip(runs, made):
            ids = np.array(e.ids, np.uint32)
            cuts = np.flatnonzero(ids == self.end)
            if len(cuts) == len(run) - 1:
                data, stops = ids.tobytes(), [*(4 * cuts).tolist(), 4 * len(ids)]
                start = 0
                for i, stop in zip(run, stops):
                    out[i] = data[start:stop]
                    start = stop + 4
        left = [i for i, x in enumerate(out) if x is None]
        for i, x in zip(left, self.whole([alone[i] for i in left])):
            out[i] = x
        return out

    def learn(self, known: Memory, pieces: set[str], lead: str) -> list[str]:
        """Lines, and letters with marks after them, are looked up by their parts.  Returns the pieces of more than
        one line: few of them are met again."""
        after, letters, marked, lines, others = lead or "\n", set(), [], [], []
        for p in known.recall(pieces):
            w = p.rstrip(punctuation)
            if w.isalpha() and (w.isascii() or max(w) < LATIN_END):
                if len(w) == len(p):
                    letters.add(p)
                else:
                    marked.append((p, w))
            elif "\n" in p and "\n" in self.begins and "" not in (parts := p.split("\n")) and p.split() == parts:
                lines.append((p, parts))
            else:
                others.append(p)
        if lines:
            self.learn(self.first, {x for _, parts in lines for x in parts[1:] if x not in self.first}, "")
            self.learn(known, {parts[0] for _, parts in lines if parts[0] not in known}, lead)
        letters.update([w for _, w in marked])
        letters = set(known.recall({w for w in letters if w not in known}))
        if after in self.begins:
            # those that are spelt otherwise stay together
            self.store(known, sorted(letters, key=str.isascii), lambda some: self.words(some, after))
        else:
            others += letters
        self.store(known, others, self.spaced if lead else self.whole)
        self.mark({p[len(w):] for p, w in marked})
        for p, w in marked:
            known[p] = known[w] + self.tails[p[len(w):]]
        for p, parts in lines:
            known[p] = self.line_end.join([known[parts[0]], *[self.first[x] for x in parts[1:]]])
        return [p for p, _ in lines]

    def store(self, known: Memory, pieces: list[str], coded) -> None:
        for i in range(0, len(pieces), 20_000):
            some = pieces[i:i + 20_000]
            known.update(zip(some, coded(some)))

    def mark(self, tails: set[str]) -> None:
        """Marks after letters are a word of their own."""
        if len(self.tails) > ENDS:
            self.tails.clear()
        new = [t for t in tails if t not in self.tails]
        self.tails.update(zip(new, self.whole(new)))

    def encode(self, texts: list[str]) -> list[bytes]:
        """No object here refers to itself, so collections would only walk through what is remembered."""
        collects = gc.isenabled()
        gc.disable()
        try:
            return [x for k in range(0, len(texts), TEXTS) for x in self.joined([pieces_of(t) for t in texts[k:k + TEXTS]])]
        finally:
            if collects:
                gc.enable()

    def joined(self, cut: list[list[str]]) -> list[bytes]:
        self.first.trim()
        self.later.trim()
        first, get, missing, tails = self.first, self.later.get, set(), []
        self.learn(first, {p[0] for p in cut if p[0] not in first}, "")
        for p in cut:
            known = list(map(get, p))
            known[0] = first[p[0]]
            holes = [i for i, x in enumerate(known) if x is None]
            missing.update([p[i] for i in holes])
            tails.append((known, holes))
        passing = self.learn(self.later, missing, " ")
        out = []
        for p, (known, holes) in zip(cut, tails):
            for i in holes:
                known[i] = get(p[i])
            out.append(b"".join(known))
        for p in passing:
            del self.later[p]
        return out


@lru_cache(maxsize=2)
def encoder(path: str, remembered: int = 1_600_000) -> Encoder:
    """One encoder for each worker process; remembered: pieces whose ids it keeps, some 220 bytes each."""
    return Encoder(path, remembered)


def slices(texts: list[str | None], most: int = 2_000_000):
    """Runs of texts of about `most` characters: (place of the first, texts), null as empty."""
    start, held, size = 0, [], 0
    for i, t in enumerate(texts):
        held.append(t or "")
        size += len(held[-1])
        if size >= most:
            yield start, held
            start, held, size = i + 1, [], 0
    if held:
        yield start, held
