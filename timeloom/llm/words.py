"""Ids of a word-end BPE (lower case, white space dropped), word by word.

The file is one of the tokenizers library. Its normalizer and its splitter
never look across ASCII white space, so a text's ids are those of its words one
after the other, and a task encodes every distinct word once. Words outside
plain ASCII, and words that hold a special token's string, are encoded by the
library itself. Plain ASCII words are cut by the same splitter and merged by
the same merge table in one call for thousands of pieces: a line feed, which no
word holds, stands for the word end. That needs a file whose ids follow its
merges (checked when it is read); otherwise the library encodes every word.
"""

from __future__ import annotations

import json
import os
import re

from timeloom.llm.common import per_process

#: The normalizer and splitter of the file, for which the short way holds.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLITTER = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Words of ASCII and of the Latin-1 letters: composed already, with a lower case of one character each.
PLAIN = re.compile(r"[\x00-\x7f\xc0-\xd6\xd8-\xf6\xf8-\xff]*")
#: The splitter on such words, in lower case, with line feeds between them.
PLAIN_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^a-z0-9\xdf-\xf6\xf8-\xff\n]+")
END = "</w>"
#: Words that a task remembers before it starts anew.
WORDS_KEPT = 400_000


def byte_symbols() -> dict[str, int]:
    """The byte that each symbol of a byte-level vocabulary stands for: visible
    Latin-1 characters stand for themselves, the others follow from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def merge_ranks(config: dict) -> dict[bytes, int] | None:
    """Ranks by bytes, the word end as a line feed; None if the file is of
    another kind than this short way knows."""
    model, symbols = config["model"], byte_symbols()
    special = {t["id"] for t in config["added_tokens"]}
    known = (config["normalizer"] or {}).get("normalizers") == NORMALIZERS and model["end_of_word_suffix"] == END \
        and config["pre_tokenizer"]["pretokenizers"][0]["pattern"] == {"Regex": SPLITTER}
    vocab = model["vocab"]
    if not known or any(vocab[m[0] + m[1]] != 512 + i for i, m in enumerate(model["merges"])):
        return None
    return {bytes(symbols[c] for c in k.removesuffix(END)) + b"\n" * k.endswith(END): v for k, v in vocab.items() if v not in special}


def load(path: str) -> tuple:
    """(library's tokenizer, pattern of its special tokens or None, short way
    or None, bytes of every id of the short way, whether it ends a piece)."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import numpy as np
    import tiktoken
    import tokenizers

    with open(path, encoding="utf-8") as f:
        config = json.load(f)
    special = "|".join(re.escape(t["content"]) for t in config["added_tokens"])
    short = sizes = ends = None
    if (ranks := merge_ranks(config)) is not None:
        short = tiktoken.Encoding("words", pat_str=r"[^\n]+\n", mergeable_ranks=ranks, special_tokens={})
        sizes, ends = np.zeros(max(ranks.values()) + 1, np.int32), np.zeros(max(ranks.values()) + 1, dtype=bool)
        for token, i in ranks.items():
            sizes[i], ends[i] = len(token.removesuffix(b"\n")), token.endswith(b"\n")
    return tokenizers.Tokenizer.from_file(path), re.compile(special) if special else None, short, sizes, ends


class WordCoder:
    """Ids of texts by a tokenizers file."""

    def __init__(self, path: str):
        import numpy as np

        self.np = np
        self.library, self.special, self.short, self.sizes, self.ends = per_process(("words", path), lambda: load(path))
        self._forget()

    def _forget(self):
        np = self.np
        self.index: dict[str, int] = {"": 0}
        self.ids, self.starts = np.zeros(0, np.uint32), np.zeros(2, np.int64)

    def _encode_words(self, words: list[str]):
        """(ids of all words in a row, ids per word)"""
        np = self.np
        plain = np.array([self.short is not None and bool(PLAIN.fullmatch(w)) and not (self.special and self.special.search(w)) for w in words], dtype=bool)
        own = [words[i] for i in np.flatnonzero(plain)]
        # every piece is followed by a line feed; the one between words is in no piece
        text = PLAIN_PIECES.sub(r"\g<0>\n", "\n".join(own).lower())
        got = np.array(self.short.encode_ordinary(text) if own else [], dtype=np.uint32)
        counts = np.zeros(len(words), np.int64)
        upto = np.cumsum(self.sizes[got]) if own else []
        # a word's last token ends where its bytes do; a mark alone may follow
        stops = np.searchsorted(upto, np.cumsum([len(w) if w.isascii() else len(w.encode()) for w in own]), side="right")
        counts[plain] = np.diff(stops, prepend=0)
        rest = np.flatnonzero(~plain)
        others = [e.ids for e in self.library.encode_batch_fast([words[i] for i in rest], add_special_tokens=False)] if len(rest) else []
        counts[rest] = [len(x) for x in others]
        out = np.zeros(counts.sum(), np.uint32)
        mine = np.repeat(plain, counts)
        out[mine] = got
        out[~mine] = np.array([x for ids in others for x in ids], dtype=np.uint32)
        return out, counts

    def encode(self, texts):
        """(ids of all texts in a row, ids per text) of an Arrow string array;
        a null text has none."""
        import pyarrow as pa
        import pyarrow.compute as pc

        np = self.np
        if len(self.index) > WORDS_KEPT:
            self._forget()
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = lists.flatten().dictionary_encode()
        if isinstance(coded, pa.ChunkedArray):
            coded = coded.combine_chunks()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        known, index = len(self.index), self.index
        at = np.array([index.setdefault(w, len(index)) for w in words], dtype=np.int32)
        if len(index) > known:
            ids, counts = self._encode_words(list(index)[known:])
            self.ids = np.concatenate([self.ids, ids])
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(counts)])
        every = at[coded.indices.to_numpy(zero_copy_only=False)] if len(coded) else np.zeros(0, np.int32)
        upto = np.zeros(len(every) + 1, np.int64)
        np.cumsum(np.diff(self.starts)[every], out=upto[1:])
        wide = np.int32 if max(upto[-1], len(self.ids)) < 1 << 31 else np.int64
        from_ = np.repeat((self.starts[every] - upto[:-1]).astype(wide), np.diff(upto))
        from_ += np.arange(upto[-1], dtype=wide)
        offsets = np.asarray(lists.offsets)
        return self.ids[from_], np.diff(upto[offsets - offsets[0]])
