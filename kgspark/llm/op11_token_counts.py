"""Token counts of whole texts by the libraries of public tokenizers, in Arrow functions.

A batch's texts are cut into units and the units packed into calls of about equal
bytes, so that neither one long text nor many short ones set the memory or the time
of a call; only lengths leave the function.  Nothing is shuffled: a file's row
groups are its tasks.

A long text is cut where the tokens of both sides are those of the whole:

- sentencepiece: between two characters that stand side by side in no piece of the
  vocabulary.  No merge can span them.  What follows the cut is encoded behind a
  character that no piece holds, so that the library's dummy prefix does not touch
  it, and the tokens of that character are subtracted.
- tokenizers, tiktoken: before a space between two ASCII letters, where every
  pattern of these vocabularies ends one word and begins another.

A stretch without such a place stays one unit, however long it is.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kgspark.llm import text as tx
from kgspark.llm.columns import packed, unpacked

#: characters of a text from which on it is cut, and of a unit, about
UNIT = 1 << 15
#: bytes of a call to the library, about
CALL = 1 << 18
#: what a normalizer that keeps texts as they are must keep (fixed value)
_PROBE = "a  b ﬁ ｆ é ① ​ x\u0007 A"
_LETTERS = re.compile(r"(?<=[A-Za-z])(?=\x20[A-Za-z])")


class Counter:
    """Counts tokens of lists of texts; `safe(text, at)` says whether a cut before `at` changes nothing.

    behind: what is put before a text that follows a cut, and its own tokens.
    """

    def __init__(self, encode: Callable[[list[str]], list[Any]], safe: Callable[[str, int], bool] | None, behind: str = ""):
        self.encode, self.safe, self.behind = encode, safe, behind
        self.extra = self.lengths([behind])[0] if behind else 0

    def lengths(self, texts: list[str]) -> list[int]:
        return [len(x) for x in self.encode(texts)]

    def units(self, text: str, size: int = UNIT) -> Iterator[str]:
        """The text in parts of about `size` characters, those after a cut behind `behind`."""
        start, n = 0, len(text)
        while n - start > size and self.safe:
            at = start + size
            back = next((i for i in range(at, start, -1) if self.safe(text, i)), None)
            at = back if back is not None else next((i for i in range(at + 1, n) if self.safe(text, i)), n)
            yield (self.behind if start else "") + text[start:at]
            start = at
        if start < n or not start:
            yield (self.behind if start else "") + text[start:]

    def counts(self, texts: Iterator[str], call: int = CALL, size: int = UNIT) -> Iterator[int]:
        """Tokens of each text, in order; each call to the library takes units of about `call` characters."""
        total, ended, held, weight = 0, [], [], 0
        for text in texts:
            for i, unit in enumerate(self.units(text, size)):
                held.append((unit, self.extra if i else 0))
                weight += len(unit)
                if weight >= call:
                    total = yield from self._flush(held, ended, total)
                    held, ended, weight = [], [], 0
            ended.append(len(held))
            if len(ended) >= 4096:  # empty texts weigh nothing
                total = yield from self._flush(held, ended, total)
                held, ended, weight = [], [], 0
        yield from self._flush(held, ended, total)

    def _flush(self, held: list[tuple[str, int]], ended: list[int], total: int) -> Iterator[int]:
        """Counts of the texts that end among these units; returns what belongs to the text still open."""
        n = self.lengths([u for u, _ in held]) if held else []
        n, start = [a - e for a, (_, e) in zip(n, held)], 0
        for end in ended:
            yield total + sum(n[start:end])
            total, start = 0, end
        return total + sum(n[start:])


@lru_cache(maxsize=4)
def load(tokenizer: str) -> Counter:
    """The counter of a tokenizer file, by its suffix; a bare name is one of the installed public files."""
    if "/" not in tokenizer:
        import public_tokenizers

        tokenizer = public_tokenizers.path(tokenizer)
    if tokenizer.endswith(".model"):
        return _pieces(tokenizer)
    if tokenizer.endswith(".json"):
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(tokenizer)
        t.no_truncation()
        t.no_padding()
        return Counter(lambda texts: t.encode_batch(texts, add_special_tokens=False), _between_words)
    if tokenizer.endswith(".tiktoken"):
        import base64

        import public_tokenizers
        import tiktoken

        with open(tokenizer, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        t = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        return Counter(lambda texts: [t.encode_ordinary(x) for x in texts], _between_words)
    raise ValueError(f"no tokenizer library for {tokenizer}")


def _between_words(text: str, at: int) -> bool:
    return bool(_LETTERS.match(text, at))


def _pieces(path: str) -> Counter:
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=path)
    encode = lambda texts: sp.encode(texts, num_threads=1)
    plain = [sp.id_to_piece(i) for i in range(len(sp)) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
    held = set().union(*plain)
    joined = {p[i : i + 2] for p in plain for i in range(len(p) - 1)}
    lone = next((c for c in "\n\x0b\x0c\x1f" if c not in held and sp.unk_id() not in sp.encode(c)), "")
    if not lone or sp.normalize(_PROBE).lstrip("▁") != _PROBE.replace(" ", "▁"):
        return Counter(encode, None)  # unknown characters would join, or normalization look across a cut
    return Counter(encode, lambda text, at: text[at - 1 : at + 1].replace(" ", "▁") not in joined, lone)


def with_token_counts(docs: DataFrame, tokenizer: str, limit: int, text: str = "text", call: int = CALL, unit: int = UNIT) -> DataFrame:
    """docs with n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit).

    tokenizer: path of a .model, .json or .tiktoken file on every node, or the bare
    name of an installed one.  Tokens are those of the library's defaults, without
    begin, end, truncation or padding.  A null text counts as empty: no bytes, no
    tokens.  Texts of any length are counted whole, each by one task; repeated rows
    and ties are counted each by itself; columns of docs with the three names are
    replaced, all others stay whatever they are called; an empty table gives an
    empty result.
    """
    made = ["n_bytes", "n_tokens", "over_limit"]
    rows = docs.select(packed(docs).alias("row"), F.col(text).alias("text"))
    return _counted(rows, tokenizer, F.lit(limit), call, unit).select(*unpacked(docs.columns, made), *made)


def _counted(rows: DataFrame, tokenizer: str, limit: Column, call: int, unit: int) -> DataFrame:
    """rows (row, text) as (row, n_bytes, n_tokens, over_limit)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = load(tokenizer)
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            n = list(counter.counts((x.as_py() for x in texts), call, unit))
            yield pa.RecordBatch.from_arrays([batch.column(0), pc.binary_length(texts).cast(pa.int64()), pa.array(n, pa.int64())], names=["row", "n_bytes", "n_tokens"])
        tx.trim()

    schema = T.StructType([rows.schema["row"], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])
    return rows.select("row", "text").mapInArrow(run, schema).withColumn("over_limit", F.col("n_tokens") > limit)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), "piece_bpe_32k.model", 4096).drop("text")
