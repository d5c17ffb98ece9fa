"""Token ids of whole texts, by the tokenizers library.

The 49k word tokenizer drops white space and splits at it, and neither its normaliser nor its
merges look across it. A text's ids are therefore those of its white-space separated chunks, one
after another, and a worker encodes each distinct chunk once. Letters A-Z are lowered first, which
the tokenizer does anyway, so that more chunks are equal. Marks at the end of a word are a token
group of their own, so ``word,`` needs no more than ``word`` and ``,``.

The tokenizer's added tokens, such as ``<|endoftext|>``, are found in the text as it is, before it
is lowered. A text that holds one is encoded as a whole by the library. In any other text they must
not be found, even if lowering its letters makes one.
"""

from __future__ import annotations

import os
import struct
import unicodedata

import numpy as np

from upkeep.llm.common import worker_state

#: Distinct chunks that a worker keeps. Further ones are encoded for their batch and forgotten.
KEPT_CHUNKS = 700_000
#: Chunks longer than this are encoded but not kept.
KEPT_BYTES = 64
#: Marks that the tokenizer splits from the letters before them: all ASCII signs but the apostrophe.
TAIL = b".,!?;:|#$%&()*+-/<=>@[]^_`{}~\"\\"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def letters_only(word: bytes) -> bool:
    """Whether a chunk is letters, also after the tokenizer has normalised it."""
    return word.isalpha() or unicodedata.normalize("NFC", word.decode()).lower().isalpha()


def packed(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit ids."""
    return struct.pack(f"<{len(ids)}I", *ids)


class ChunkEncoder:
    """Encodes texts to bytes: little-endian unsigned 32-bit ids."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.marks = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model
        self.suffix = self.model.end_of_word_suffix or ""
        self.last = np.zeros(self.tokenizer.get_vocab_size(), bool)  # ids that end a word
        for token, number in self.tokenizer.get_vocab().items():
            self.last[number] = bool(self.suffix) and token.endswith(self.suffix)
        self.known: dict[bytes, bytes] = {}

    @staticmethod
    def of(path: str) -> ChunkEncoder:
        """The worker's encoder for the file at ``path``."""
        loaded = worker_state().setdefault("encoders", {})
        if path not in loaded:
            loaded[path] = ChunkEncoder(path)
        return loaded[path]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each UTF-8 text."""
        marked = [any(m in t for m in self.marks) for t in texts]
        if any(marked):
            found = self.encode_chunks([b"" if m else t for t, m in zip(texts, marked)])
            for i in np.flatnonzero(marked):
                ids = self.tokenizer.encode(texts[i].decode(), add_special_tokens=False).ids
                found[i] = np.array(ids, "<u4").tobytes()
            return found
        return self.encode_chunks(texts)

    def encode_chunks(self, texts: list[bytes]) -> list[bytes]:
        """The ids of texts without added tokens."""
        known, done, open_texts, missing = self.known, [], [], set()
        for text in texts:
            chunks = text.lower().split()
            parts = list(map(known.get, chunks))
            try:
                done.append(b"".join(parts))
            except TypeError:  # an unknown chunk gives None
                places = [k for k, part in enumerate(parts) if part is None]
                missing.update([chunks[k] for k in places])
                open_texts.append((len(done), chunks, parts, places))
                done.append(b"")
        if not missing:
            return done
        self.tokenizer.encode_special_tokens = True  # lowered chunks hold no added token
        try:
            found = self.learned(missing)
        finally:
            self.tokenizer.encode_special_tokens = False
        for i, chunks, parts, places in open_texts:
            for k in places:
                parts[k] = found[chunks[k]]
            done[i] = b"".join(parts)
        if len(known) + len(found) <= KEPT_CHUNKS:
            known.update(found)
        return done

    def learned(self, chunks: set[bytes]) -> dict[bytes, bytes]:
        """The ids of each chunk, with those of their words and marks."""
        found, plain, letters, rest, split = {}, [], [], [], []

        def sort_in(word: bytes) -> None:
            if self.suffix and word.isalpha():  # of bytes: ASCII letters
                plain.append(word)
            elif self.suffix and letters_only(word):
                letters.append(word)
            else:
                rest.append(word)

        for chunk in chunks:
            word = chunk.rstrip(TAIL)
            if word == chunk:
                sort_in(chunk)
            elif letters_only(word):  # other signs would form one group with the marks
                split.append((chunk, word))
            else:
                rest.append(chunk)
        parts = {w for _, w in split} | {c[len(w) :] for c, w in split}
        for word in parts.difference(chunks).difference(self.known):
            sort_in(word)
        for word in plain:
            found[word] = packed([t.id for t in self.model.tokenize(word.decode())])
        for start in range(0, len(letters), 200):
            some = letters[start : start + 200]
            ids = np.array(self.tokenizer.encode(b" ".join(some).decode(), add_special_tokens=False).ids, "<u4")
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) == len(some) and ends[-1] == len(ids):  # no chunk is more than one word
                joined, at = ids.tobytes(), [0, *(4 * ends).tolist()]
                found.update(zip(some, (joined[a:b] for a, b in zip(at, at[1:]))))
            else:
                rest.extend(some)
        for start in range(0, len(rest), 10_000):
            some = rest[start : start + 10_000]
            encoded = self.tokenizer.encode_batch_fast([c.decode() for c in some], add_special_tokens=False)
            found.update((c, packed(e.ids)) for c, e in zip(some, encoded))
        for chunk, word in split:
            tail = chunk[len(word) :]
            found[chunk] = (found.get(word) or self.known.get(word) or b"") + (found.get(tail) or self.known[tail])
        return found
