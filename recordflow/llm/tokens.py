"""Encoding whole texts with a public vocabulary file, word by word through a cache.

Both supported vocabularies cut a text before merging, and no merge crosses a
cut, so the ids of a text are the ids of its white-space chunks in a row. Most
chunks of a text were seen before; only new ones go to the tokenizer. Under a
byte-level vocabulary, short chunks of many texts are cut and found at once.
"""

from __future__ import annotations

import os
import re
from collections import defaultdict
from itertools import chain, count, islice

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
os.environ.setdefault("RAYON_NUM_THREADS", "1")

# White space that the vocabularies' patterns know beside the ASCII kind, and
# the four separators that only Python counts as white space.
_ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0  -     　]")
_SEPARATORS = ("\x1c", "\x1d", "\x1e", "\x1f")
_CHUNK = re.compile(rb"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")
# Runs of two blanks or line ends come apart by the simple cut just as the
# pattern takes them apart; longer runs, those at a text's end and other white
# space don't.
_RARE = (b"\t", b"\r", b"\x0b", b"\x0c", b"\x00")
_PAIRS = tuple(a + b for a in (b" ", b"\n") for b in (b" ", b"\n"))
_TRIPLES = tuple(p + c for p in _PAIRS for c in (b" ", b"\n"))
_SPACES = frozenset(b" \t\n\x0b\x0c\r")
# A mark after a word is a token run of its own, so it can be cut off: words
# then stand in the cache once, not once per mark. That holds where no other
# mark, blank or character beyond ASCII stands before it.
_MARKS = (b",", b".", b"!", b"?", b";", b":")
_KIND = bytes(ord("s") if b in _SPACES else ord("w") if chr(b).isalnum() and b < 128 else ord("p") if 32 < b < 127 else ord("x") for b in range(256))
_UNSURE = (b"pp", b"sps", b"xps")


# Letters (ASCII and Latin-1, which no normaliser takes apart) are one token run,
# marks after them another: the vocabulary's model takes both as they are. An
# apostrophe isn't among the marks, as it may go with letters.
_LETTERS, _TAIL = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+", "[!-&(-/:-@\\[-`{-~]*"
_PLAIN, _MARKED = re.compile(f"()({_LETTERS})({_TAIL})"), re.compile(f"([\x00\n]?)({_LETTERS})({_TAIL})")
# The same for many keys in a row, each ended by \x01: one match per key, without letters where the key has another form.
_IN_A_ROW = {p: re.compile(f"{p.pattern}\x01|[^\x01]*\x01") for p in (_PLAIN, _MARKED)}
_WORDS_TO_TRY = ("a", "word", "Words", "THE", "internationalisation", "xyzzyqj", "Of", "s", "ll", "tokenISER",
                 "\u00e9t\u00e9", "\u00c8RE", "gr\u00fc\u00dfe", "\u00d8\u00ff", "\u00e0\u00ed", "word,", "Of&&&", "\u00c9a###", "x.)", "a<|", "s;-", "\u00fc!?")
# How byte-level vocabularies write bytes: printable ones as themselves, the others in order from 256 on.
_SHOWN = [b for b in range(256) if 33 <= b < 127 or 161 <= b < 173 or b > 173]
_BYTE_LEVEL = np.arange(256, dtype="<u2")
_BYTE_LEVEL[[b for b in range(256) if b not in _SHOWN]] = np.arange(256, 512 - len(_SHOWN))
_BYTE_LEVEL[10] = 10  # line ends part words here


def _marks_apart(raw: bytes, gap: bytes) -> bytes:
    """``raw`` with ``gap`` before each mark that ends a word, if that is sure to change no id."""
    kinds = raw.translate(_KIND)
    if any(x in kinds for x in _UNSURE):
        return raw
    for m in _MARKS:
        if m in raw:
            raw = raw.replace(m + b" ", gap + m + b" ").replace(m + b"\n", gap + m + b"\n")
    return raw


# What a byte is to the cut of many texts: c cuts, r needs the closer look, w may stand before a mark, m is a mark.
_ROLE = bytes(ord("c") if b in b" \n" else ord("r") if bytes([b]) in _RARE else ord("w") if _KIND[b] == ord("w") else ord("m") if bytes([b]) in _MARKS else 0 for b in range(256))
_U = np.uint64
_ALL = _U(0xFFFFFFFFFFFFFFFF)
_FIRST_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)

_loaded: dict[tuple, "ChunkCache"] = {}


def vocabulary(name: str) -> str:
    """Path of an installed public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def loaded(kind: type, *args) -> "ChunkCache":
    """The encoder of this worker process, made on first use and kept for later tasks, until another one is asked for."""
    if (kind, args) not in _loaded:
        _loaded.clear()
        _loaded[kind, args] = kind(*args)
    return _loaded[kind, args]


class _Index(defaultdict):
    """Numbers keys in the order in which they are first asked for."""

    def __init__(self):
        super().__init__(count().__next__)


def _in_a_row(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    size = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int64, int(size.sum())), size


class ChunkCache:
    """Ids of chunks, kept by chunk. ``max_entries`` and ``max_ids`` bound it; when it is full it starts anew."""

    KEPT_AS = np.uint16

    def __init__(self, max_entries: int = 1_000_000, max_ids: int = 8_000_000):
        self.max_entries, self.max_ids = max_entries, max_ids
        self._clear()

    def _clear(self) -> None:
        self.index = _Index()
        self.ids = np.empty(1 << 20, self.KEPT_AS)
        self.off = np.zeros(1 << 18, np.int64)
        self.n = 0

    def ids_of(self, keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``keys`` in a row, and the number of ids of each."""
        raise NotImplementedError

    def _learn(self, keys: list[bytes]) -> None:
        """Append the ids of ``keys``, which the index has numbered from ``self.n`` on."""
        flat, size = self.ids_of(keys)
        at = self.off[self.n]
        while at + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        while self.n + len(keys) + 1 > len(self.off):
            self.off = np.concatenate([self.off, np.zeros_like(self.off)])
        self.ids[at:at + len(flat)] = flat
        self.off[self.n + 1:self.n + 1 + len(keys)] = at + np.cumsum(size)
        self.n += len(keys)

    def look_up(self, keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``keys`` in a row, and the place of each key's first id (and the end)."""
        if self.n > self.max_entries or self.off[self.n] > self.max_ids:
            self._clear()
        at = np.fromiter(map(self.index.__getitem__, keys), np.int64, len(keys))
        if len(self.index) > self.n:
            self._learn(list(islice(reversed(self.index), len(self.index) - self.n))[::-1])
        return self._gather(at)

    def _gather(self, at: np.ndarray, more: np.ndarray | int = 0) -> tuple[np.ndarray, np.ndarray]:
        """``look_up`` by the keys' numbers; ``more`` places after each key's ids are free to be filled."""
        start = self.off[at]
        size = self.off[at + 1] - start + more
        ends = np.concatenate([[0], np.cumsum(size)])
        return self.ids.take(np.repeat(start - ends[:-1], size) + np.arange(ends[-1]), mode="clip"), ends


class ShortKeys(ChunkCache):
    """Ids of keys of at most 16 bytes, found for many keys at once.

    A key is two 64-bit numbers, kept by its number and compared whole. A slot
    holds one number; a key whose two slots others take is new again later.
    """

    BITS = 22
    WIDTH = 16

    def __init__(self, ids_of):
        self.ids_of = ids_of
        super().__init__(2_000_000, 16_000_000)

    def _clear(self) -> None:
        super()._clear()
        self.n = 1  # 0: no key, without ids
        self.slots = np.zeros(1 << self.BITS, np.int32)
        self.low, self.high = np.full(1 << 18, _ALL), np.full(1 << 18, _ALL)  # of no key, as UTF-8 has no such bytes

    def _slots(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = (low ^ (high * _U(0x9E3779B97F4A7C15))) * _U(0xBF58476D1CE4E5B9)
        h ^= h >> _U(32)
        h *= _U(0x94D049BB133111EB)
        return h >> _U(64 - self.BITS), (h >> _U(64 - 2 * self.BITS)) & _U((1 << self.BITS) - 1)

    def numbers(self, buf: bytes, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """The numbers of the keys ``buf[start:stop]``, 0 for longer ones; ``buf`` goes on for 16 bytes after the last."""
        if self.n > self.max_entries or self.off[self.n] > self.max_ids:
            self._clear()
        out = [np.empty(0, np.int32)]
        for i in range(0, len(start), 1 << 17):  # bounds the memory for a long text
            out.append(self._some(buf, start[i:i + (1 << 17)], stop[i:i + (1 << 17)]))
        return np.concatenate(out)

    def _some(self, buf: bytes, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        size = stop - start
        eight = np.ndarray(len(buf) - 7, "<u8", buf, 0, (1,))  # the eight bytes from each place on
        low = eight[start] & _FIRST_BYTES[np.minimum(size, 8)]
        high = eight[start + 8] & _FIRST_BYTES[np.clip(size - 8, 0, 8)]
        first, second = self._slots(low, high)
        out = self.slots[first]
        left = np.flatnonzero((self.low[out] != low) | (self.high[out] != high))
        again = self.slots[second[left]]
        out[left] = np.where((self.low[again] == low[left]) & (self.high[again] == high[left]), again, 0)
        out[size > self.WIDTH] = 0
        new = left[(out[left] == 0) & (size[left] <= self.WIDTH)]
        if len(new):
            new = new[np.lexsort((high[new], low[new]))]
            a, b = low[new], high[new]
            differs = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))
            out[new] = self.n - 1 + np.cumsum(differs)
            one = new[differs]
            number = out[one]
            while number[-1] >= len(self.low):
                self.low, self.high = (np.append(x, np.full_like(x, _ALL)) for x in (self.low, self.high))
            self._learn([buf[i:j] for i, j in zip(start[one].tolist(), stop[one].tolist())])
            self.low[number], self.high[number] = low[one], high[one]
            self.slots[np.where(self.slots[first[one]] == 0, first[one], second[one])] = number
        return out


def _key(chunk: bytes) -> bytes:
    """The cache key of a chunk: bare after one blank, as it is after one line end, else marked by a 0."""
    if len(chunk) > 1 and chunk[1] and chunk[1] not in _SPACES:
        if chunk[0] == 32:
            return chunk[1:]
        if chunk[0] == 10:
            return chunk
    return b"\x00" + chunk


class ChunkEncoder(ChunkCache):
    """Ids of texts under a ``tokenizers`` file, as its plain ``encode`` gives them.

    ``spaces``: the vocabulary keeps white space (byte-level), so a chunk
    carries the white space before it; otherwise white space only separates. A
    text that holds a special token of the file is encoded whole. Ids are kept
    in 16 bits; a larger vocabulary is refused.
    """

    BLOCK = 512  # new chunks encoded by one call

    def __init__(self, path: str, spaces: bool):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        added = self.tok.get_added_tokens_decoder()
        if max([self.tok.get_vocab_size() - 1, *added]) > 0xFFFF:
            raise ValueError(f"{path}: ids over 65,535 don't fit in 16 bits")
        self.special = [t.content.lower() for t in added.values()]
        self.heads = {c for t in added.values() for c in (t.content[:2], t.content[:2].upper(), t.content[:2].lower())}
        # A control character between blanks is cut off on both sides, so it
        # can stand between chunks that are encoded in one call.
        self.mark = " \x01" if spaces else " \x01 "
        self.mark_ids = self.tok.encode(self.mark, add_special_tokens=False).ids
        self.spaces = spaces
        self.model = self.tok.model
        self.end = self.tok.encode("\n", add_special_tokens=False).ids
        self.runs: dict[str, list[int]] = {}  # ids of marks that end a word
        tried = [lead + w for lead in ("", "\x00", "\n")[:3 if spaces else 1] for w in _WORDS_TO_TRY]
        known = [i for k in tried for i in self.tok.encode(self._text(k.encode()), add_special_tokens=False).ids]
        self.by_model = not any(_PLAIN.fullmatch(f"a{t.content}") or _PLAIN.fullmatch(t.content) for t in added.values()) and (
            self._words(self._forms([k.encode() for k in tried]))[0].tolist() == known)
        marks = [self.tok.encode(m.decode(), add_special_tokens=False).ids for m in _MARKS]
        self.at_once = spaces and all(len(ids) == 1 for ids in marks)
        self.mark_id = np.zeros(256, self.KEPT_AS)
        self.mark_id[[m[0] for m in _MARKS]] = [ids[0] if ids else 0 for ids in marks]
        self.short: ShortKeys | None = None
        super().__init__()

    def _forms(self, keys: list[bytes]) -> list[tuple[str, str, str]]:
        """The parts of each key that the model takes as they are: what stands before, letters, marks; no letters: another form."""
        joined = b"\x01".join(keys) + b"\x01"
        if joined.count(b"\x01") != len(keys):
            joined = b"\x01".join([k.replace(b"\x01", b"\x02") for k in keys]) + b"\x01"  # both are of no such form
        return _IN_A_ROW[_MARKED if self.spaces else _PLAIN].findall(joined.decode())

    def _words(self, forms: list[tuple[str, str, str]]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of letters and marks in a row and the number of each, from the model behind the file's normaliser and cutting."""
        words = "\n".join([w if lead or not self.spaces else " " + w for lead, w, _ in forms])
        if not self.spaces:
            words = words.lower()
        words = _BYTE_LEVEL[np.frombuffer(words.encode(), np.uint8)].tobytes().decode("utf-16-le")
        tokenize, end, runs = self.model.tokenize, self.end, self.runs
        flat: list[int] = []
        ends = []
        for (lead, _, marks), tokens in zip(forms, map(tokenize, words.split("\n"))):
            if lead == "\n":
                flat += end
            flat += [t.id for t in tokens]
            if marks:
                if marks not in runs:
                    if len(runs) >= 10_000:
                        runs.clear()
                    runs[marks] = [t.id for t in tokenize(marks)]
                flat += runs[marks]
            ends.append(len(flat))
        return np.array(flat, np.int64), np.diff(np.array(ends, np.int64), prepend=0)

    def _has_special(self, text: str) -> bool:
        """Whether a special token may be inside (in any case, as a normaliser may change it)."""
        return any(h in text for h in self.heads) and any(t in text.lower() for t in self.special)

    def _odd(self, text: str) -> bool:
        """White space that the chunks don't know."""
        return any(x in text for x in _SEPARATORS) if text.isascii() else _ODD_SPACE.search(text) is not None

    def _chunks(self, text: str) -> list[bytes]:
        raw = text.encode()
        if self._has_special(text):
            return [b"\x00" + raw] if self.spaces else [raw]
        if not self.spaces:
            return _marks_apart(raw, b" ").split()
        if self._odd(text):
            return [b"\x00" + raw]
        if any(x in raw for x in _RARE) or (any(p in raw for p in _PAIRS) and (raw[-2:] in _PAIRS or any(t in raw for t in _TRIPLES))):
            return [_key(c) for c in _CHUNK.findall(raw)]
        parts = _marks_apart(raw, b" \x00").replace(b"\n", b" \n").split(b" ")
        first = parts.pop(0)
        return [b"\x00" + first, *parts] if first else parts

    def _text(self, key: bytes) -> str:
        """What a cache key stands for: 0 and the chunk as it is, or a chunk after a blank."""
        if not self.spaces:
            return key.decode()
        return (key[1:] if key[:1] == b"\x00" else key if key[:1] == b"\n" else b" " + key).decode()

    def _together(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """The ids of all texts by one call and the number of each text's, or None where that can't be told apart."""
        joined = self.mark.join(texts)
        if joined.count("\x01") != len(texts) - 1 or self._has_special(joined):
            return None
        flat = np.array(self.tok.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.int64)
        at = np.flatnonzero(flat == self.mark_ids[-1])
        k = len(self.mark_ids)
        if len(at) != len(texts) - 1:
            return None
        keep = np.ones(len(flat), bool)
        keep[(at[:, None] - np.arange(k)).ravel()] = False
        return flat[keep], np.append(at + 1 - k, len(flat)) - np.concatenate([[0], at + 1])

    def ids_of(self, keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        size, done = np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        found: list[tuple[np.ndarray, np.ndarray]] = []  # numbers of chunks, their ids in a row
        if self.by_model:
            forms = self._forms(keys)
            done[:] = [f[1] != "" for f in forms]
            if done.any():
                part = np.flatnonzero(done)
                flat, size[part] = self._words([f for f in forms if f[1]])
                if len(part) == len(keys):
                    return flat, size
                found.append((part, flat))
        left = np.flatnonzero(~done).tolist()
        texts = {j: self._text(keys[j]) for j in left}
        if self.spaces:  # only a chunk that begins with white space and goes on is cut off on both sides
            safe = [j for j, t in texts.items() if t[0] in " \n" and t[-1] not in " \n\t\r\x0b\x0c" and keys[j][:1] != b"\x00"]
        else:
            safe = left
        for i in range(0, len(safe), self.BLOCK):
            part = np.array(safe[i:i + self.BLOCK])
            one = self._together([texts[j] for j in part])
            if one is not None:
                size[part], done[part] = one[1], True
                found.append((part, one[0]))
        rest = np.flatnonzero(~done)
        for i in range(0, len(rest), self.BLOCK):
            part = rest[i:i + self.BLOCK]
            flat, size[part] = _in_a_row([e.ids for e in self.tok.encode_batch_fast([texts[j] for j in part], add_special_tokens=False)])
            found.append((part, flat))
        start = np.cumsum(size) - size
        out = np.empty(int(size.sum()), np.int64)
        for part, flat in found:
            n = size[part]
            out[np.repeat(start[part] - (np.cumsum(n) - n), n) + np.arange(len(flat))] = flat
        return out, size

    def _cut(self, texts: list[str]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The chunks of many texts: a buffer with their keys, start and end of each, how many each text has, and which texts need the closer look instead."""
        closer = np.array([self._has_special(t) or self._odd(t) for t in texts], bool)
        raw = [b"" if c else t.encode() for t, c in zip(texts, closer)]
        buf = b"\x00" + b" \x00".join(raw) + b" " + bytes(ShortKeys.WIDTH)
        begin = np.cumsum([0, *(len(r) + 2 for r in raw[:-1])])
        role = np.frombuffer(buf.translate(_ROLE), np.uint8)[:-ShortKeys.WIDTH]
        stop = np.flatnonzero(role == ord("c"))
        start = np.append(0, stop[:-1] + (np.frombuffer(buf, np.uint8)[stop[:-1]] == ord(" ")))
        first = np.searchsorted(start, begin)
        rare = np.flatnonzero(role == ord("r"))  # the 0 before each text is one
        rare = np.append(rare[~np.isin(rare, begin)], stop[:-2][stop[2:] - stop[:-2] == 2])
        closer[np.searchsorted(begin, rare, "right") - 1] = True
        keep = np.repeat(~closer, np.diff(first, append=len(start)))
        keep[first[stop[first] - start[first] == 1]] = False  # only that 0: an empty text, or white space begins it
        per = np.diff(np.append(0, np.cumsum(keep))[np.append(first, len(start))])
        return buf, start[keep], stop[keep], per, closer

    def _encode_at_once(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if self.short is None:
            self.short = ShortKeys(self.ids_of)
        buf, start, stop, per, closer = self._cut(texts)
        b = np.frombuffer(buf, np.uint8)
        role = np.frombuffer(_ROLE, np.uint8)
        marked = (role[b[stop - 1]] == ord("m")) & (role[b[stop - 2]] == ord("w")) & (stop - start > 1)
        marks, stop = np.where(marked, b[stop - 1], 0), stop - marked
        at = self.short.numbers(buf, start, stop)
        other = np.flatnonzero(at == 0)
        keys = [buf[i:j] for i, j in zip(start[other].tolist(), stop[other].tolist())]
        if closer.any():  # their chunks go in between
            text = np.flatnonzero(closer)
            chunks = [self._chunks(texts[i]) for i in text.tolist()]
            n = np.array([len(c) for c in chunks], np.int64)
            before = np.cumsum(per)[text]
            between = np.repeat(before, n)
            at, marks = np.insert(at, between, 0), np.insert(marks, between, 0)
            order = np.argsort(np.append(other, between - 0.5), kind="stable")
            keys += chain.from_iterable(chunks)
            keys = [keys[i] for i in order.tolist()]
            other = np.flatnonzero(at == 0)
            per[text] = n
        ids, ends = self.look_up(keys)
        more = (marks > 0).astype(np.int64)
        size = np.diff(ends)
        more[other] += size
        flat, place = self.short._gather(at, more)
        flat[np.repeat(place[other] - ends[:-1], size) + np.arange(len(ids))] = ids
        marked = np.flatnonzero(marks)
        flat[place[marked + 1] - 1] = self.mark_id[marks[marked]]
        return flat, np.diff(place[np.append(0, np.cumsum(per))])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row (unsigned 16 bits) and the number of ids of each text."""
        if self.at_once and texts:
            return self._encode_at_once(texts)
        keys: list[bytes] = []
        per = np.zeros(len(texts) + 1, np.int64)
        for i, t in enumerate(texts):
            keys += self._chunks(t)
            per[i + 1] = len(keys)
        if not keys:
            return np.empty(0, np.uint16), np.zeros(len(texts), np.int64)
        flat, ends = self.look_up(keys)
        return flat, np.diff(ends[per])


class WordPairEncoder(ChunkCache):
    """Ids of single words under two vocabularies, from one look-up.

    A ``sentencepiece`` model takes each word as a text of its own; a byte-level
    ``tokenizers`` file takes it as after a blank, its ids raised by ``split``,
    the size of the former, so that the two are told apart.
    """

    KEPT_AS = np.uint32

    def __init__(self, piece_path: str, byte_path: str):
        import sentencepiece

        self.piece = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        self.split = self.piece.get_piece_size()
        self.is_byte = np.array([self.piece.is_byte(i) for i in range(self.split)])
        self.level = ChunkEncoder(byte_path, True)
        super().__init__(400_000, 4_000_000)  # its workers go on to other stages

    def ids_of(self, keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        texts = [k.decode("utf-8", "replace") for k in keys]
        one, n_one = _in_a_row(self.piece.encode(texts, num_threads=1))
        two, n_two = self.level.ids_of([t.encode() if t[0] != "\x00" else b"\x00 " + t.encode() for t in texts])
        size = n_one + n_two
        start = np.cumsum(size) - size
        out = np.empty(int(size.sum()), np.int64)
        for ids, n, at in ((one, n_one, start), (two + self.split, n_two, start + n_one)):
            out[np.repeat(at - (np.cumsum(n) - n), n) + np.arange(len(ids))] = ids
        return out, size
