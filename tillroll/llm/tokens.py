"""Token ids of texts by a public tokenizer file, in Arrow batches.

Tokenizers that drop white space give a text the ids of its words one after
another, so each distinct word is encoded once per worker and texts are put
together from the cached ids.
"""

from __future__ import annotations

import json
import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa

from tillroll.llm.common import worker_state

# The split pattern of word vocabularies and the byte alphabet's printable bytes.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]

#: Units of words made of ASCII without "'" (which begins units of its own) and of letters that lower-casing and
#: composition leave one by one; OTHER is what such words don't have. Words end at a newline.
UNITS = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[!-&(-/:-@\[-`{-~]+|\n")
OTHER = re.compile(r"[^\n!-&(-~À-ÖØ-öø-ÿ]")

#: Words whose ids a worker remembers at most, and units; only a part's own words may be more.
MOST_WORDS = 350_000

#: Bytes of texts that are split into words at once; a longer text is split alone.
PART_BYTES = 4 << 20

#: Texts whose ids are gathered at once.
GATHERED = 256


class Known(dict):
    """Words' numbers; -1 for others."""

    def __missing__(self, word: bytes) -> int:
        return -1


class WordTokens:
    """Ids of whole texts through a cache of words; for tokenizers whose ids don't span white space."""

    def __init__(self, path: str, special: bool = True):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks share the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special  # else their strings are ordinary text
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        steps = [n["type"] for n in (made.get("normalizer") or {}).get("normalizers", [])]
        cuts = (made.get("pre_tokenizer") or {}).get("pretokenizers", [])
        #: In such a vocabulary a plain word's letters are one unit: its merges alone give the ids.
        self.by_unit = (steps == ["NFC", "Replace", "Lowercase"] and [c["type"] for c in cuts] == ["Split", "ByteLevel"]
                        and cuts[0]["pattern"].get("Regex") == WORD_PATTERN and not cuts[1]["add_prefix_space"])
        others = [b for b in range(256) if b not in PRINTABLE]
        self.letters = {b: chr(b) for b in PRINTABLE} | {b: chr(256 + i) for i, b in enumerate(others)}
        #: Strings that have ids of their own wherever they stand in a text.
        self.added = [t["content"] for t in made.get("added_tokens", []) if t["content"]]
        self.units: dict[str, tuple[int, ...]] = {}
        self.clear()

    def ids_of(self, words: list[bytes]) -> tuple[list[bytes], list[int], list[int]]:
        """The words in another order, their ids one after another, and where each word's ids end."""
        texts = [w.decode() for w in words]
        odd = [not self.by_unit or OTHER.search(t) is not None or any(map(t.__contains__, self.added)) for t in texts]
        ids, ends = [], []
        known, unit = self.units, self.unit
        for u in UNITS.findall("".join([t + "\n" for t, o in zip(texts, odd) if not o]).lower()):
            if u == "\n":
                ends.append(len(ids))
            else:
                ids += known.get(u) or unit(u)
        for found in self.tokenizer.encode_batch_fast([t for t, o in zip(texts, odd) if o], add_special_tokens=False):
            ids += found.ids
            ends.append(len(ids))
        return [w for w, o in zip(words, odd) if not o] + [w for w, o in zip(words, odd) if o], ids, ends

    def unit(self, text: str) -> tuple[int, ...]:
        """Ids of one unit of the word pattern."""
        spelt = text if text.isascii() else text.encode().decode("latin-1").translate(self.letters)
        found = self.units[text] = tuple([t.id for t in self.tokenizer.model.tokenize(spelt)])
        return found

    def clear(self) -> None:
        self.code = Known()
        self.flat = np.zeros(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 14, np.int64)  # of the words' ids in flat; one more than words

    def gather(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of known words one after another, and where each word's begin and end."""
        starts = self.starts[codes]
        sizes = self.starts[codes + 1] - starts
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return self.flat[np.repeat(starts - ends[:-1], sizes) + np.arange(int(ends[-1]))], ends

    def add(self, words: list[bytes], ids: np.ndarray | list[int], ends: np.ndarray) -> None:
        """Remember words by their ids one after another and where each word's end."""
        n = len(self.code)
        used = int(self.starts[n])
        total = used + len(ids)
        if total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(total, len(self.flat)), np.uint32)])
        if n + len(words) + 1 > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros(max(len(words) + 1, len(self.starts)), np.int64)])
        self.flat[used:total] = ids
        self.starts[n + 1:n + len(words) + 1] = used + ends
        self.code.update(zip(words, range(n, n + len(words))))

    def keep(self, words: list[bytes], codes: np.ndarray) -> None:
        """Forget all words but these."""
        ids, ends = self.gather(codes)
        self.clear()
        self.add(words, ids, ends[1:])

    def learn(self, new: list[bytes]) -> None:
        """Remember the ids of words that aren't yet."""
        for at in range(0, len(new), 4096):
            if len(self.units) > MOST_WORDS:
                self.units.clear()
            words, ids, ends = self.ids_of(new[at:at + 4096])
            self.add(words, ids, np.array(ends, np.int64))

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of each text. Splits at ASCII white space; other white space stays inside a word's text."""
        out, first, size = [], 0, 0
        for k, text in enumerate(texts):
            if size and size + len(text) > PART_BYTES:
                out += self.encode_part(texts[first:k])
                first, size = k, 0
            size += len(text)
        return out + self.encode_part(texts[first:])

    def encode_part(self, texts: list[bytes]) -> list[np.ndarray]:
        split = [t.split() for t in texts]
        # each distinct word is looked up once
        held = pa.array(chain.from_iterable(split), pa.large_binary()).dictionary_encode()
        words = held.dictionary.to_pylist()
        codes = np.fromiter(map(self.code.__getitem__, words), np.int64, len(words))
        unknown = np.flatnonzero(codes < 0)
        if len(unknown):
            if len(self.code) + len(unknown) > MOST_WORDS:  # words that come again stay
                known = np.flatnonzero(codes >= 0)
                self.keep([words[k] for k in known.tolist()], codes[known])
                codes[known] = np.arange(len(known))
            new = [words[k] for k in unknown.tolist()]
            self.learn(new)
            codes[unknown] = [self.code[w] for w in new]
        codes = codes[held.indices.to_numpy()]
        edge = np.cumsum([0, *map(len, split)])
        out = []
        for at in range(0, len(texts), GATHERED):
            edges = edge[at:at + GATHERED + 1]
            ids, ends = self.gather(codes[edges[0]:edges[-1]])
            bounds = ends[edges - edges[0]].tolist()
            out += [ids[a:b] for a, b in zip(bounds, bounds[1:])]
        return out


def word_tokens(path: str, special: bool = True) -> WordTokens:
    """``special``: strings of special tokens in a text get their ids."""
    return worker_state(("word_tokens", path, special), lambda: WordTokens(path, special))
