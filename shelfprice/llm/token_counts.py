"""Token counts of documents, by the tokenizer's own library, without the tokens.

Texts are encoded in Arrow functions that return lengths only. Texts are cut into pieces where no token can reach
across and what follows does not depend on what came before. A call of the library gets a batch of about the same
number of bytes whatever the documents are like, and each different piece once as long as it is remembered.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COUNTS = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"

#: Before a blank or line feed that follows a character which is surely no blank. Byte-level pre-tokenizers separate
#: there: a blank begins a piece and never ends one that has other characters.
_SAFE = re.compile(r"(?<=[!-~\w])(?=[ \n])")
_UNSAFE = re.compile(r"(?:^|[^!-~\w])[ \n]")
#: Marks after a Latin letter begin a piece of their own.
_MARKS = ".,!?;:"
_LATIN = r"[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]"
_ENDS_IN_LETTER = re.compile(f".*{_LATIN}", re.DOTALL)


def cuts_are_safe(model: dict) -> bool:
    """Whether a tokenizer file's texts may be cut before a blank that follows a visible character, and before marks.

    So for byte-level pre-tokenizers with their standard pattern and nothing that looks at the text before: no
    normalizer, no blank put in front, no truncation, and added tokens that neither hold such a place nor look beyond
    themselves.
    """
    pre = model.get("pre_tokenizer") or {}
    plain = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space", True)
    alone = all(
        not any(t.get(k) for k in ("single_word", "lstrip", "rstrip")) and not re.search(rf"\s|{_LATIN}[{_MARKS}]", t["content"])
        for t in model.get("added_tokens") or []
    )
    return plain and alone and not model.get("normalizer") and not model.get("truncation")


def counter(path: str) -> tuple[Callable[[list[str]], list[int]], bool]:
    """A function from texts to their numbers of tokens, and whether texts may be cut for it."""
    if path.endswith(".model"):
        from sentencepiece import SentencePieceProcessor

        pieces = SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for ids in pieces.encode(texts, num_threads=1)], False
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        safe = cuts_are_safe(json.load(f))
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda texts: [len(e) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)], safe


class Pieces:
    """Numbers of tokens of pieces between safe places, remembered for up to ``most`` different pieces.

    The library is called with unknown pieces only, in batches of about ``batch_bytes`` characters, so that neither
    one long text nor many short ones make a call large.
    """

    def __init__(self, count: Callable[[list[str]], list[int]], most: int, batch_bytes: int):
        self.count, self.most, self.batch_bytes, self.known = count, most, batch_bytes, {}

    def learn(self, keys: set[str]) -> None:
        """Words followed by marks are counted as the word and the marks, so that each word is encoded once."""
        if len(self.known) + len(keys) > self.most:
            self.known = {}
        missing = keys.difference(self.known)
        marked = {k: (w, "\0" + k[len(w) :]) for k in missing if k and k[-1] in _MARKS and _ENDS_IN_LETTER.fullmatch(w := k.rstrip(_MARKS))}
        batch, size = [], 0
        for key in missing.difference(marked).union(*marked.values()).difference(self.known):
            batch.append(key)
            size += len(key)
            if size >= self.batch_bytes:
                self._add(batch)
                batch, size = [], 0
        if batch:
            self._add(batch)
        self.known.update((k, self.known[word] + self.known[marks]) for k, (word, marks) in marked.items())

    def _add(self, keys: list[str]) -> None:
        self.known.update(zip(keys, self.count([_piece(k) for k in keys]), strict=True))

    def __call__(self, texts: list[list[str]]) -> list[int]:
        self.learn(set().union(*texts))
        of = self.known.__getitem__
        return [sum(map(of, keys)) for keys in texts]


def _piece(key: str) -> str:
    """A key is a piece after its mark: nothing for one that follows a blank, a zero for one that is as it stands."""
    return key[1:] if key[:1] == "\0" else key if key[:1] == "\n" else " " + key


def keys(text: str) -> list[str]:
    """The pieces of a text as keys. Cut are only safe places: a blank or line feed after a visible character."""
    if _UNSAFE.search(text) or "\0" in text:
        return ["\0" + p for p in _SAFE.split(text)]
    first, *rest = text.replace("\n", " \n").split(" ")
    return ["\0" + first, *rest]


def _groups(texts: list[str | None], most: int) -> Iterator[list[str]]:
    """The texts in order, in groups of about this many characters."""
    group, size = [], 0
    for text in texts:
        group.append(text or "")
        size += len(group[-1])
        if size >= most:
            yield group
            group, size = [], 0
    if group:
        yield group


def _count(path: str, limit: int, known: int, batch_bytes: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    count, safe = counter(path)
    pieces = Pieces(count, known, batch_bytes)
    for batch in batches:
        n = []
        for texts in _groups(batch.column(2).to_pylist(), batch_bytes):
            n += pieces([keys(t) for t in texts]) if safe else count(texts)
        n = np.array(n, np.int64)
        yield pa.record_batch(
            [batch.column(0), batch.column(1), pa.array(n), pa.array(n > limit)],
            ["doc_id", "n_bytes", "n_tokens", "over_limit"],
        )


def count_tokens(docs: DataFrame, tokenizer: str, *, doc_id: str = "doc_id", text: str = "text", limit: int = 1024, known_pieces: int = 800_000, batch_bytes: int = 1 << 20) -> DataFrame:
    """Per document: its UTF-8 bytes, its tokens, and whether these are more than ``limit``.

    ``tokenizer`` is the path of a tokenizer file on every machine: ``.json`` is read by ``tokenizers``, ``.model`` by
    ``sentencepiece``. Tokens are those of the whole text, without any that the library adds at its ends; special
    strings in a text are treated as the library does by default, and nothing is cut off or padded.

    Texts are cut where that cannot change their tokens, and a call of the library gets pieces of about ``batch_bytes``
    characters together, without those of the up to ``known_pieces`` that a task remembers. What has no such place (a
    word, a text of a script without blanks) is one piece, and texts for a tokenizer for which no such places are known
    (see cuts_are_safe) go to the library whole. Neither option changes the result.

    A null text is empty and has no bytes and no tokens. Rows with a null or repeated id are documents of their own.
    Further columns are ignored. An empty table gives none.
    """
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long").alias("n_bytes"), F.col(text).alias("text"))
    return own.mapInArrow(lambda b: _count(tokenizer, limit, known_pieces, batch_bytes, b), COUNTS)
