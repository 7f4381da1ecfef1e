"""Token ids of whole texts, with the ids of each word kept for the next text that has it.

The vocabularies used here drop white space before merging, so a text's ids are those
of its words in turn. Words of plain letters go straight to the merge model; whatever
else occurs between two blanks is given to the whole tokenizer.
"""

import json
import re
import sys
import types

import numpy as np

# Words whose ids a task process keeps before it starts anew; about 200 bytes each.
KEPT_WORDS = 500_000
# Lower-case letters that no normal form changes; one mark may follow.
PLAIN = re.compile("([a-zß-öø-ÿ]+)([.,]?)")


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """Path of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


class WordEncoder:
    def __init__(self, path: str, kept_words: int = KEPT_WORDS):
        from tokenizers import Tokenizer, pre_tokenizers

        self.path, self.kept_words = path, kept_words
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        with open(path, encoding="utf-8") as file:
            steps = json.load(file).get("pre_tokenizer") or {}
        # Only where white space is removed do words stand alone.
        steps = steps.get("pretokenizers", [steps])
        self.by_word = any(step.get("behavior") == "Removed" for step in steps)
        byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.shown = {ch: byte_level.pre_tokenize_str(ch)[0][0] for ch in map(chr, [*range(0x61, 0x7B), *range(0xDF, 0x100)])}
        self.shown = str.maketrans(self.shown)
        self.marks = {"": b"", ".": self._any("."), ",": self._any(",")}
        self.known: dict[bytes, bytes] = {}

    def _any(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, words) -> None:
        if len(self.known) > self.kept_words:
            self.known.clear()
        known, tokenize = self.known, self.model.tokenize
        for word in words:
            if word in known:
                continue
            text = word.decode("utf-8", "replace")
            plain = PLAIN.fullmatch(text)
            if not plain:
                known[word] = self._any(text)
                continue
            stem, mark = plain.groups()
            key = word[:-1] if mark else word
            if key not in known:
                shown = stem if stem.isascii() else stem.translate(self.shown)
                known[key] = np.array([t.id for t in tokenize(shown)], "<u4").tobytes()
            if mark:
                known[word] = known[key] + self.marks[mark]

    def encode(self, raw: bytes) -> bytes:
        """Ids of a UTF-8 text as little-endian unsigned 32-bit integers."""
        if not self.by_word:
            return self._any(raw.decode("utf-8", "replace"))
        # Special tokens are found before letters become lower case.
        words = (raw if b"<|" in raw else raw.lower()).split()
        known = self.known
        try:
            return b"".join([known[word] for word in words])
        except KeyError:
            self._learn(set(words))
            return b"".join([known[word] for word in words])


def encoder(path: str, kept_words: int = KEPT_WORDS) -> WordEncoder:
    """The encoder of this process; tasks that a worker process runs one after another share it."""
    shelf = sys.modules.setdefault("_word_encoders", types.ModuleType("_word_encoders"))
    if path not in vars(shelf):
        setattr(shelf, path, WordEncoder(path))
    vars(shelf)[path].kept_words = kept_words
    return vars(shelf)[path]


def raw_texts(column) -> list[bytes]:
    """A string column of an Arrow batch as UTF-8; null is empty."""
    return [raw or b"" for raw in column.cast("binary").to_pylist()]
