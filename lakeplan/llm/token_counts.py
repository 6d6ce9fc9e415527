"""Token counts by a map-side two-tier lookup.

Tier one is a broadcast table with the token lengths of the corpus' frequent pre-tokens. Tier two is a cache kept by each
Python worker, filled by encoding the pre-tokens that miss. No pre-token is shuffled: what moves is each task's bounded
summary of frequent words, from which the table is built. The table only saves work; counts are exact whatever it holds.

Defined results: NULL text counts as empty (0 bytes, 0 tokens); the special string inside a text is one token, as the
library gives by default; repeated ids give one row per input row; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from functools import partial

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeplan.llm import common

VOCABULARY = "byte_bpe_50k.json"
SPECIAL = "<|endoftext|>"
TABLE_WORDS = 65_536
TASK_WORDS = 8_192
COUNTER_WORDS = 300_000
CACHE_WORDS = 600_000
TOKEN_LIMIT = 512

#: Code points that the pattern classifies alike in every Unicode version in use; other texts go to the library whole.
STABLE = r"[^\x00-ԯḀ-⁯₠-₿ぁ-ゖ゠-ヿ一-龥가-힣]"

_WORKER: dict = {}


class LengthCache(dict):
    """Token lengths; a miss is encoded and kept. At ``bound`` words the misses go, the broadcast words stay."""

    def __init__(self, frequent: dict[str, int], encode, bound: int):
        super().__init__(frequent)
        self.frequent, self.encode, self.bound = frequent, encode, bound

    def __missing__(self, word: str) -> int:
        n = len(self.encode(word, add_special_tokens=False).ids)
        if len(self) >= self.bound:
            self.clear()
            self.update(self.frequent)
        self[word] = n
        return n


def frequent_words(docs: DataFrame, text: str = "text", table_words: int = TABLE_WORDS, task_words: int = TASK_WORDS) -> DataFrame:
    """(word, n): letters-only words that follow a space, by frequency over all texts.

    Each task counts its words with a bounded counter and hands on its most frequent ones; the sums of these are
    lower bounds of the true counts.
    """
    def count(batches):
        seen: Counter = Counter()
        for batch in batches:
            for value in batch.column(0).to_pylist():
                words = (value or "").split(" ")
                words[0] = ""
                seen.update(words)
                if len(seen) > COUNTER_WORDS:
                    seen = Counter(dict(seen.most_common(COUNTER_WORDS // 2)))
        top = [(w, n) for w, n in seen.most_common(2 * task_words) if w.isalpha()][:task_words]
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())],
                                         names=["word", "n"])

    per_task = common.map_arrow(docs.select(text), count, "word string, n long")
    totals = per_task.groupBy("word").agg(F.sum("n").alias("n"))
    return totals.orderBy(F.col("n").desc(), "word").limit(table_words)


def length_table(words: list[str], vocabulary: str = VOCABULARY) -> dict[str, int]:
    """Token lengths of the words with the space that precedes them."""
    encode = load(common.tokenizer_file(vocabulary)).encode
    return {f" {w}": len(encode(f" {w}", add_special_tokens=False).ids) for w in words}


def load(path: str):
    common.worker_threads()
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _worker(vocabulary: str, frequent) -> dict:
    """The tokenizer and its cache, kept by the Python process from one task to the next."""
    key = (vocabulary, frequent.id if hasattr(frequent, "id") else id(frequent))
    if _WORKER.get("key") != key:
        import public_tokenizers

        tokenizer = load(common.tokenizer_file(vocabulary))
        _WORKER.update(key=key, tokenizer=tokenizer, cache=LengthCache(frequent.value, tokenizer.encode, CACHE_WORDS),
                       split=regex.compile(public_tokenizers.PATTERN).findall, unstable=regex.compile(STABLE).search)
    return _WORKER


def count_tokens(text: str, worker: dict) -> int:
    """Tokens of a whole text: special strings apart, then the sum of the pre-tokens' lengths."""
    if not text.isascii() and worker["unstable"](text):
        return len(worker["tokenizer"].encode(text, add_special_tokens=False).ids)
    segments = text.split(SPECIAL)
    look = worker["cache"].__getitem__
    return len(segments) - 1 + sum(sum(map(look, worker["split"](s))) for s in segments)


def token_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY,
                 limit: int = TOKEN_LIMIT, table_words: int = TABLE_WORDS) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for each row of ``docs``."""
    table = length_table([r.word for r in frequent_words(docs, text, table_words).collect()], vocabulary)
    frequent = docs.sparkSession.sparkContext.broadcast(table)

    def make(frequent=frequent):
        worker = _worker(vocabulary, frequent)

        def score(ids, texts):
            values = [t or "" for t in texts.to_pylist()]
            counts = [count_tokens(t, worker) for t in values]
            return {"doc_id": ids, "n_bytes": [len(t.encode()) for t in values], "n_tokens": counts,
                    "over_limit": [n > limit for n in counts]}
        return score

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    kinds = {"doc_id": pa.int64(), "n_bytes": pa.int64(), "n_tokens": pa.int64(), "over_limit": pa.bool_()}
    run = common.per_row(partial(make), ["doc_id", "text"], kinds)
    return common.map_arrow(rows, run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
