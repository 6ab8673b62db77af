"""Token ids of whole texts, as a public tokenizers file gives them, at a multiple of its speed.

A word-level BPE with an end-of-word suffix is turned into a rank table in which a
space plays the suffix. Texts of letters, spaces, line feeds and single full stops and commas
then need no more than lower case and a space around each mark to be merged in one
call. Other texts go by their chunks: the tokenizer never joins characters across a
space or line feed, so a text's ids are the ids of its chunks in order. Each worker
keeps a bounded table of chunks; new ones of letters go through the ranks, the
rest to the tokenizers library.
"""

from __future__ import annotations

import json
import os
from operator import add
from unicodedata import is_normalized

import numpy as np

#: Chunks that a worker remembers; the table starts anew beyond it.
CACHE = 150_000
#: Ends a word in the rank table.
END = " "


def _byte_letters() -> dict[str, int]:
    """The public byte-level alphabet: printable bytes stand for themselves, the others for characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class WordRanks:
    """Byte-level BPE over whole words with an end-of-word suffix, as ranks: the suffix joins the last letter first."""

    def __init__(self, spec: dict):
        import tiktoken

        model, letters = spec["model"], _byte_letters()
        vocab, suffix, end = model["vocab"], model["end_of_word_suffix"], END.encode()

        def raw(token: str) -> bytes:
            word = token.removesuffix(suffix)
            return bytes(letters[c] for c in word) + end * (word != token)

        ids = [(bytes([b]), vocab.get(c)) for c, b in letters.items()]
        ids += [(bytes([b]) + end, vocab.get(c + suffix)) for c, b in letters.items() if bytes([b]) != end]
        ids += [(raw(t), vocab[t]) for t in ("".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"])]
        if len({t for t, _ in ids}) < len(ids):
            raise ValueError("two merges make the same token")
        self.encoding = tiktoken.Encoding("words", pat_str=f"[^{END}]+{END}", mergeable_ranks={t: i for i, (t, _) in enumerate(ids)},
                                          special_tokens={})
        self.id = np.array([0 if i is None else i for _, i in ids], "<u4")
        self.ends = np.array([t.endswith(end) and len(t) > 1 for t, _ in ids])

    @classmethod
    def of(cls, spec: dict) -> WordRanks | None:
        """None for a tokenizer of another kind."""
        model, text = spec["model"], json.dumps([spec["normalizer"], spec["pre_tokenizer"]])
        fits = model["type"] == "BPE" and model.get("end_of_word_suffix") and not model.get("dropout") and not spec.get("post_processor")
        if not (fits and "Lowercase" in text and "NFC" in text and "ByteLevel" in text):
            return None
        try:
            return cls(spec)
        except (ValueError, KeyError):
            return None

    def text(self, text: str) -> bytes:
        """Ids of a text that ``is_plain``."""
        t = text.lower().replace("\n", " ").replace(".", " . ").replace(",", " , ") + END
        return self.id[self.encoding.encode_to_numpy(t, disallowed_special=())].tobytes()

    def words(self, words: list[str]) -> list[bytes]:
        """Ids of words of lower-case letters."""
        r = np.asarray(self.encoding.encode_to_numpy(END.join(words) + END, disallowed_special=()))
        ids, cut = self.id[r].tobytes(), (4 * np.nonzero(self.ends[r])[0] + 4).tolist()
        return [ids[a:b] for a, b in zip([0, *cut], cut)]


def plain_letter(c: str) -> bool:
    """A letter that lower case and composition treat alike wherever it stands."""
    low = c.lower()
    return c.isalpha() and len(low) == 1 and low.isalpha() and c != "Σ" and is_normalized("NFC", c)


class WordTokens:
    """uint32 little-endian ids of texts, by a tokenizers file whose words end at white space."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            self.ranks = WordRanks.of(json.load(f))
        self.known: dict[str, bytes] = {"": b""}
        self.plain, self.odd = set(" \n.,"), set()

    def is_plain(self, text: str) -> bool:
        """Only letters, spaces, line feeds, and full stops and commas that do not follow each other."""
        for c in (chars := set(text)) - self.plain - self.odd:
            (self.plain if plain_letter(c) else self.odd).add(c)
        return chars <= self.plain and not (".." in text or ".," in text or ",." in text or ",," in text) and (
            text.isascii() or is_normalized("NFC", text))

    def _learn(self, new: set[str]) -> None:
        """Ids of new chunks. ASCII case is folded by the tokenizer, and a full stop or comma after a letter is a
        token of its own, so those chunks are put together from known ones."""
        known, plain, other, whole, cores, ends = self.known, set(), set(), [], [], []
        for w in new:
            core, end = w, ""
            if w[-1] in ".," and w[-2:-1].isalpha():
                core, end = w[:-1], w[-1]
            if core.isalpha():
                if core.isascii():
                    core = core.lower()
                    if core not in known:
                        plain.add(core)
                elif core not in known:
                    (plain if core == core.lower() and is_normalized("NFC", core) else other).add(core)
            elif core not in known:
                other.add(core)
            if core != w:
                whole.append(w)
                cores.append(core)
                ends.append(end)
        if self.ranks is None:
            other |= plain
        elif plain:
            plain = list(plain)
            known.update(zip(plain, self.ranks.words(plain)))
        other |= {".", ","} - known.keys()
        if other:
            other = list(other)
            for w, e in zip(other, self.tokenizer.encode_batch_fast(other, add_special_tokens=False)):
                known[w] = np.asarray(e.ids, "<u4").tobytes()
        get = known.__getitem__
        known.update(zip(whole, map(add, map(get, cores), map(get, ends))))

    def ids(self, texts: list[str]) -> list[bytes]:
        out = [self.ranks.text(t) if self.ranks is not None and self.is_plain(t) else None for t in texts]
        split = [texts[i].replace("\n", " ").split(" ") for i, x in enumerate(out) if x is None]
        words = set().union(*split)
        if len(self.known) + len(words) > CACHE:
            self.known = {"": b""}
        if new := words - self.known.keys():
            self._learn(new)
        get, rest = self.known.__getitem__, iter(split)
        return [b"".join(map(get, next(rest))) if x is None else x for x in out]


_LOADED: dict[str, WordTokens] = {}


def word_tokens(path: str) -> WordTokens:
    """The worker's own instance."""
    if path not in _LOADED:
        _LOADED[path] = WordTokens(path)
    return _LOADED[path]
