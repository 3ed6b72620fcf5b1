"""Token ids of whole texts by the tokenizers library, through a memo of space-led chunks.

A text is cut in front of every single space; each chunk is encoded once and its ids
are kept as bytes, so a document is a join of memo entries. The cut is exact for the
byte-level pattern except where a space stands between two white-space characters or
between white space and the end; such texts are encoded whole.
"""

from __future__ import annotations

import array
import contextlib
import gc
import json
import os
import re
import sys
import unicodedata

#: Unicode White_Space, fixed values
WHITE_SPACE = "".join(map(chr, [
    *range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
ASCII_PAIRS = tuple(c + " " for c in WHITE_SPACE if c < "\x80")
OTHER_PAIRS = tuple(c + " " for c in WHITE_SPACE if c >= "\x80")
#: entries of a memo's generation, and the longest chunk kept
MEMO_ENTRIES, MEMO_CHARS = 600_000, 64
#: code points of the texts that are cut into chunks at once, and chunks encoded in one call
AT_ONCE, TOGETHER = 4_000_000, 2_000


def splittable(text: str) -> bool:
    """No white space in front of a space: cutting before each space changes no token."""
    return not any(p in text for p in ASCII_PAIRS) and (
        text.isascii() or not any(p in text for p in OTHER_PAIRS)
    )


def keys(text: str) -> list[str]:
    """The chunks of ``text`` as a memo names them, without strings made anew: a chunk that
    a space leads is named by what follows, the first one by itself behind a space."""
    out = text.split(" ")
    out[0] = " " + out[0]
    return out


def flipped(x: str) -> str:
    """From a chunk to its name, or back."""
    return x[1:] if x[:1] == " " else " " + x


def chunks(text: str) -> list[str]:
    """``text`` cut in front of each space; their concatenation is the text."""
    head, *rest = text.split(" ")
    return [head, *[" " + x for x in rest]] if head else [" " + x for x in rest]


#: ASCII marks that are neither letter, number nor white space
MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())


def closed(c: str) -> bool:
    """Whether ``c`` is alphanumeric and ends so however it is normalised: of some letters
    (U+0130 lowered, U+0958 composed) a mark comes last, which goes with the marks behind it."""
    return c.isalnum() and (c < "\x80" or unicodedata.normalize("NFC", c).lower()[-1].isalnum())


def atoms(chunk: str) -> list[str]:
    """A chunk cut around single line ends and before closing marks: cuts that the
    split patterns make themselves, so a word is encoded once whatever follows it."""
    if "\n" not in chunk:
        if chunk[-1].isalnum():
            return [chunk]
        core = chunk.rstrip(MARKS)
        return [core, chunk[len(core):]] if core and core != chunk and closed(core[-1]) else [chunk]
    lines = chunk.split("\n")
    if any(not x or x[-1] in WHITE_SPACE for x in lines) or any(x[0] in WHITE_SPACE for x in lines[1:]):
        return [chunk]
    out = []
    for i, line in enumerate(lines):
        if i:
            out.append("\n")
        core = line.rstrip(MARKS)
        if core != line and core and closed(core[-1]):
            out += [core, line[len(core):]]
        else:
            out.append(line)
    return out


class Memo(dict):
    """chunk -> value of ``make(chunk)``, in two generations: when the young one is full
    it becomes the old one, and what is met again moves back, so frequent chunks stay."""

    def __init__(self, make, entries: int = MEMO_ENTRIES):
        super().__init__()
        self.make, self.entries, self.old = make, entries, {}

    def __missing__(self, chunk):
        value = self.old.get(chunk)
        if value is None:
            value = self.make(chunk)
        if len(chunk) <= MEMO_CHARS:
            if len(self) >= self.entries:
                self.old = dict(self)
                self.clear()
            self[chunk] = value
        return value


@contextlib.contextmanager
def uncollected():
    """Memos and cut texts hold no cycles, yet their many objects make the collector run
    again and again; it waits until a bounded batch is done."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


def le32(ids) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    a = array.array("I", ids)
    if sys.byteorder == "big":
        a.byteswap()
    return a.tobytes()


#: letters that are in every version of Unicode, compose with none of the others and have
#: one lower-case letter each; a run of them, maybe led by a space, and the marks that close it
LETTERS = "A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF"
LETTER_RUN = re.compile(f"( ?[{LETTERS}]+)([{re.escape(MARKS)}]*)")
#: how vocabularies treat text before their model sees it, where a run of letters is one
#: piece: normalizer and pre_tokenizer -> whether the space stays, whether letters are lowered
_BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True}
_WORD_SPLIT = {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}
LETTERS_WHOLE = [
    (None, _BYTE_LEVEL | {"use_regex": True}, True, False),
    ({"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
     {"type": "Sequence", "pretokenizers": [
         {"type": "Split", "pattern": _WORD_SPLIT, "behavior": "Removed", "invert": True}, _BYTE_LEVEL | {"use_regex": False}]}, False, True),
]


class LibraryEncoder:
    """``ids(texts)``: the library's ids of whole texts as little-endian uint32 bytes.

    Chunks not met before are encoded by one call of the library's batch form without
    offsets. Where the vocabulary leaves a run of letters whole, the library's model takes
    such a run at once, without the steps in front of it.

    An encoder can be broadcast: it is made anew where it is read, and goes with all that it
    keeps when its worker turns to tasks that do not read it."""

    def __reduce__(self):
        return type(self), (self.path, self.word_ends, self.entries)

    def __init__(self, path: str, word_ends: bool = False, entries: int = MEMO_ENTRIES):
        self.path, self.word_ends, self.entries = path, word_ends, entries
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one core per task
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        # a vocabulary that drops white space can be cut before any space
        self.splittable = (lambda _: True) if word_ends else splittable
        # name of a chunk -> ids, in two generations like those of a memo
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.long: list[str] = []
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.marks = {t[0] for t in self.special}
        self.model = self.tokenizer.model
        with open(path, encoding="utf-8") as f:
            steps = json.load(f)
        found = [x[2:] for x in LETTERS_WHOLE if x[:2] == (steps.get("normalizer"), steps.get("pre_tokenizer"))]
        # added tokens are found first; none must lie in a run of letters
        whole = bool(found) and not steps["model"].get("dropout") and not any(
            re.fullmatch(f"[ {LETTERS}]*", t) for t in self.special)
        self.run = LETTER_RUN.fullmatch if whole else (lambda _: None)
        self.space, self.lower = found[0] if whole else (True, False)
        one = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.stand_ins = {c: one(chr(c))[0][0] for c in [32, *range(0xC0, 0x100)]}
        # what a letter becomes; the stand-in of a space is in place by then
        self.letters = {c: x for c, x in self.stand_ins.items() if c != 32}

    def _encode(self, text: str) -> bytes:
        return le32(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _letters(self, runs: list[str]) -> list[bytes]:
        """The ids of named runs of letters: one piece each for the model."""
        lead = self.stand_ins[32] if self.space else ""
        pieces = [x[1:] if x[0] == " " else lead + x for x in ([x.lower() for x in runs] if self.lower else runs)]
        stand_ins, tokenize = self.letters, self.model.tokenize
        return [le32([t.id for t in tokenize(x if x.isascii() else x.translate(stand_ins))]) for x in pieces]

    def _atoms(self, chunk: str) -> list[str]:
        if any(m in chunk for m in self.marks) and any(t in chunk for t in self.special):
            return [chunk]
        return atoms(chunk)

    def ids(self, texts: list[str | None]) -> list[bytes]:
        out, some, size = [], [], 0
        for text in texts:
            some.append(text)
            size += len(text or "")
            if size >= AT_ONCE:
                out += self._some(some)
                some, size = [], 0
        return out + self._some(some)

    def _fill(self, wanted: set[str], special: bool) -> None:
        """Put the ids of each of ``wanted``, names of chunks, into the young generation."""
        young, old, run = self.young, self.old, self.run
        runs, ended, parts, cores, lacking = [], [], {}, set(), set()
        for c in wanted.difference(young):
            value = old.get(c)
            if value is not None:
                young[c] = value
                continue
            found = None if special and any(t in flipped(c) for t in self.special) else run(c)
            if found is None:
                chunk = flipped(c)
                if not chunk:
                    young[c] = b""
                    continue
                parts[c] = cut = [flipped(x) for x in (self._atoms(chunk) if special else atoms(chunk))]
                for x in cut:
                    found = run(x) if len(cut) > 1 else None
                    (cores if found and found.end(1) == len(x) else lacking).add(x)
            elif found.end(1) == len(c):
                runs.append(c)
            else:
                ended.append((c, found[1], " " + found[2]))
        lacking.update([tail for _, _, tail in ended])
        lacking = {x for x in lacking if not self._met(x)}
        cores.update([core for _, core, _ in ended])
        runs += [x for x in cores.difference(runs) if not self._met(x)]
        young.update(zip(runs, self._letters(runs)))
        some = list(lacking.difference(young))
        for k in range(0, len(some), TOGETHER):
            found = self.tokenizer.encode_batch_fast([flipped(x) for x in some[k:k + TOGETHER]], add_special_tokens=False)
            young.update(zip(some[k:k + TOGETHER], [le32(e.ids) for e in found]))
        young.update([(c, young[core] + young[tail]) for c, core, tail in ended])
        young.update([(c, b"".join(map(young.__getitem__, cut))) for c, cut in parts.items()])
        self.long = [x for x in (*wanted, *some, *runs) if len(x) > MEMO_CHARS]

    def _met(self, x: str) -> bool:
        """Whether ``x`` is kept; then it is in the young generation."""
        if x not in self.young:
            if x not in self.old:
                return False
            self.young[x] = self.old[x]
        return True

    def _age(self) -> None:
        """After a batch: what is long goes, and a full generation becomes the old one."""
        for x in self.long:
            self.young.pop(x, None)
        if len(self.young) >= self.entries:
            self.old, self.young = self.young, {}

    @uncollected()
    def _some(self, texts: list[str | None]) -> list[bytes]:
        cut = [keys(x) if x and self.splittable(x) else None for x in texts]
        wanted = set().union(*filter(None, cut))
        self._fill(wanted, any(t in x for x in texts if x for t in self.special))
        value = self.young.__getitem__
        out = [
            b"".join(map(value, parts)) if parts else self._encode(text) if text else b""
            for text, parts in zip(texts, cut)
        ]
        self._age()
        return out


_ENCODERS: dict = {}


def library_encoder(path: str, word_ends: bool = False, entries: int = MEMO_ENTRIES) -> LibraryEncoder:
    """One encoder per process, vocabulary and size of its memo."""
    key = (path, word_ends, entries)
    if key not in _ENCODERS:
        _ENCODERS[key] = LibraryEncoder(*key)
    return _ENCODERS[key]
