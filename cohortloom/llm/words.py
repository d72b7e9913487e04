"""Token ids of whole texts by the ``tokenizers`` library, with a memory of words."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np

from cohortloom.llm.common import SPACES

#: Words a worker process remembers between documents; a full memory is emptied, results do not depend on it.
MEMORY_ENTRIES = 1_200_000
#: New words that are encoded in one call.
TOGETHER = 512
#: Characters of texts whose new words are looked for together.
CHARS_TOGETHER = 250_000


@lru_cache(maxsize=4)
def id_bytes(path: str) -> Callable[[Iterable[str]], Iterator[bytes]]:
    """texts -> the ids of each as little-endian unsigned 32-bit integers, without special tokens; one for each worker process.

    For tokenizers that lower-case, drop white space and split letters, single digits, other characters and English
    contractions, never merging across these: then a text's ids are those of its words in turn, and a word's without an
    apostrophe those of its runs. Texts that hold the string of an added token, such as ``<|endoftext|>``, in any case,
    go to the library whole, which takes it for that token.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    added = sorted(t.content.lower() for t in library.get_added_tokens_decoder().values())
    has_added = re.compile("|".join(map(re.escape, added))).search if added else lambda _: None
    mark = "\x01"
    marked = library.encode(mark, add_special_tokens=False).ids
    known: dict[str, bytes] = {}
    split = re.compile(SPACES).split
    # beyond these Python and the library may differ on case, composition or white space; such texts are left as they are
    unusual = re.compile("[\x01\x1c-\x1fİɐ-\U0010ffff]").search

    suffix = getattr(library.model, "end_of_word_suffix", None)
    last = np.zeros(library.get_vocab_size() + 1, bool)
    for token, number in library.get_vocab().items():
        last[number] = bool(suffix) and token.endswith(suffix)
    letter, digit = "a-zA-Zªµº\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f", "0-9²³¹¼½¾"
    parts_of = re.compile(f"[{letter}]+|[{digit}]|[^{letter}{digit}]+").findall

    def cut(words: list[str], data: bytes, begins: list[int], ends: list[int]) -> None:
        known.update(zip(words, (data[4 * a : 4 * b] for a, b in zip(begins, ends, strict=True)), strict=True))

    def learn_each(new: list[str]) -> None:
        for word, made in zip(new, library.encode_batch_fast(new, add_special_tokens=False), strict=True):
            known[word] = np.array(made.ids, "<u4").tobytes()

    def learn_marked(new: list[str]) -> None:
        for at in range(0, len(new), TOGETHER):
            some = new[at : at + TOGETHER]
            ids = np.array(library.encode(f" {mark} ".join(some), add_special_tokens=False).ids, "<u4")
            cuts = np.flatnonzero(ids == marked[0]).tolist()
            cut(some, ids.tobytes(), [0, *(c + 1 for c in cuts)], [*cuts, len(ids)])

    def learn_letters(new: list[str]) -> None:
        """Words of letters alone: each ends with the one of its tokens that has the suffix."""
        for at in range(0, len(new), TOGETHER):
            some = new[at : at + TOGETHER]
            ids = np.array(library.encode(" ".join(some), add_special_tokens=False).ids, "<u4")
            cuts = (np.flatnonzero(last[ids]) + 1).tolist()
            if len(cuts) == len(some):
                cut(some, ids.tobytes(), [0, *cuts[:-1]], cuts)
            else:
                learn_each(some)

    def learn(new: list[str], plain: bool) -> None:
        if not plain or len(marked) != 1:
            return learn_each(new)
        letters, others, joined = [], [], []
        for word in new:
            if word.isalpha():
                letters.append(word)
            elif "'" in word:
                others.append(word)
            else:
                joined.append((word, parts_of(word)))
        parts = {p for _, ps in joined for p in ps}.difference(known, letters)
        letters += [p for p in parts if p.isalpha()]
        learn_letters(letters) if suffix else learn_marked(letters)
        learn_marked(others + [p for p in parts if not p.isalpha()])
        for word, ps in joined:
            known[word] = b"".join([known[p] for p in ps])
        return None

    def encode_some(texts: list[str]) -> list[bytes]:
        whole = {i: np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for i, t in enumerate(texts) if has_added(t.lower())}
        texts = ["" if i in whole else t for i, t in enumerate(texts)] if whole else texts
        plain = [not unusual(text) for text in texts]
        words = [text.lower().split() if p else split(text) for text, p in zip(texts, plain, strict=True)]
        if len(known) > MEMORY_ENTRIES:
            known.clear()
        for kind in (True, False):
            if new := set().union(*(w for w, p in zip(words, plain, strict=True) if p is kind)).difference(known):
                learn(list(new), kind)
        find = known.__getitem__
        return [whole[i] if i in whole else b"".join(map(find, w)) for i, w in enumerate(words)]

    def encode(texts: Iterable[str]) -> Iterator[bytes]:
        some: list[str] = []
        size = 0
        for text in texts:
            some.append(text)
            size += len(text)
            if size >= CHARS_TOGETHER:
                yield from encode_some(some)
                some, size = [], 0
        yield from encode_some(some)

    return encode
