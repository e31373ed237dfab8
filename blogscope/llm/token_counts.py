"""Token counts without running the tokenizer over every word (operator 3).

The SentencePiece model has no vocabulary string that holds the word mark after another
character, so no merge ever crosses the place before a word mark: a text's pieces are
the pieces of its units, and a unit is a run of word marks with what follows. That is
checked on the vocabulary when the model is loaded, as is the list of *whole* units:
vocabulary strings which, encoded alone, come back as exactly one piece. Whole units
count one each by look-up. All other units are merged by the library once per task and
remembered in a table of bounded size.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import decode, table, text_list, texts, tokenizer_path

MARK = "▁"
MODEL = "piece_bpe_32k.model"
MEMO_UNITS = 400_000  # remembered units per task, then the table starts again

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


class UnitCounter:
    """Pieces per unit: whole units by look-up, the rest merged by the library."""

    def __init__(self, path: str, memo_units: int = MEMO_UNITS):
        import sentencepiece
        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.memo_units = memo_units
        self.whole = self.prove()
        self.memo = dict(self.whole)
        self.merged = 0

    def prove(self) -> dict[str, int]:
        """Units (without their first word mark) that are one piece; raises where the
        vocabulary would let a merge cross a unit's edge."""
        sp = self.sp
        pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())
                  if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("a vocabulary string holds a word mark after another character")
        starts = [p[1:] for p in pieces if p.startswith(MARK) and len(p) > 1]
        ids = sp.encode([s.replace(MARK, " ") for s in starts], num_threads=1)
        whole = {s.replace(MARK, " "): 1 for s, i in zip(starts, ids) if len(i) == 1}
        if MARK in pieces:
            whole[""] = 1  # a lone word mark
        return whole

    @staticmethod
    def units(text: str) -> list[str]:
        """The units of a text, each without its first word mark, marks as spaces."""
        if not text:
            return []
        parts = text.replace(MARK, " ").split(" ")
        if "" not in parts:
            return parts
        out, run = [], 0
        for p in parts:
            if p:
                out.append(" " * run + p)
                run = 0
            else:
                run += 1
        if run:
            out.append(" " * (run - 1))
        return out

    def counts(self, batch: list[str]) -> list[int]:
        units = [self.units(t) for t in batch]
        if len(self.memo) > self.memo_units:
            self.memo = dict(self.whole)
        memo = self.memo
        new = list(set().union(*units).difference(memo)) if units else []
        for lo in range(0, len(new), 50_000):
            part = new[lo:lo + 50_000]
            memo.update(zip(part, map(len, self.sp.encode(part, num_threads=1))))
        self.merged += len(new)
        return [sum(map(memo.__getitem__, u)) for u in units]


def token_counts(docs: DataFrame, path: str | None = None, limit: int = 4096) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of ``docs`` (doc_id, text).

    One pass, no shuffle. Null text counts as empty (0 bytes, 0 tokens); repeated rows and
    null ids give one row each; an empty table gives an empty result; further columns are
    ignored. Texts of any length are counted whole.
    """
    path = path or tokenizer_path(MODEL)

    def run(batches):
        counter = UnitCounter(path)
        for b in batches:
            raw = text_list(b.column("text"))
            n = []
            for lo in range(0, len(raw), 256):
                n += counter.counts([decode(x) for x in raw[lo:lo + 256]])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(map(len, raw), pa.int64()), pa.array(n, pa.int64()),
                 pa.array([x > limit for x in n], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return texts(docs).mapInArrow(run, SCHEMA)


def op3_token_counts(spark, sf_dir):
    return token_counts(table(spark, sf_dir, "documents"))
