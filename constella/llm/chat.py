"""Operator 4: chat formatting with offset-aligned loss masks.

A conversation is rendered whole: per turn a start marker, the role, a line break, the text, an end
marker and a line break. It is encoded once, with offsets. The sorted spans of the assistant texts
are intersected with the tokens' sorted spans by binary search; a token is under the loss mask if it
overlaps such a span, and the characters it covers outside the span are not.

Control strings inside texts and roles are broken by a backslash after their first character, and
backslashes are doubled, so no text can close its turn and the texts can be read back exactly.

Grouping: a conversation is one row of the result, so its turns meet in one task; what meets there is
one conversation, never a group of conversations. Row cases: null text, role or turn: empty text,
empty role, first place. Rows of the same turn are ordered by role, then text; repeated rows are
turns of their own. Null conv_ids are one conversation. An empty table gives an empty result. Other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.processors import ByteLevel

from constella.llm.common import lean_batches, table

VOCABULARY = "byte_bpe_50k.json"
START, END = "<|turn|>", "<|end|>"
# fixed values: strings that steer common chat templates, this one's included
CONTROLS = ("<|", "<s>", "</s>", "[INST]", "[/INST]")
TRAINED_ROLE = "assistant"
BATCH = 64
_SCHEMA = ("conv_id long, formatted string, token_ids array<int>, token_starts array<int>, token_ends array<int>, "
           "loss_mask array<boolean>, loss_spans array<struct<start:int,end:int>>")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(re.escape(START) + r"(.*?)\n(.*?)" + re.escape(END) + "\n", re.DOTALL)
_tokenizers: dict[str, Tokenizer] = {}


def escape(text: str, line: bool = False) -> str:
    """Reversible; with ``line`` (roles) line breaks are broken too."""
    text = text.replace("\\", "\\\\")
    for c in CONTROLS:
        text = text.replace(c, c[0] + "\\" + c[1:])
    return text.replace("\n", "\\\x1f") if line else text


def unescape(text: str, line: bool = False) -> str:
    return _ESCAPED.sub(lambda m: "\n" if line and m[1] == "\x1f" else m[1], text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation, and the spans of the texts to learn, in order."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape(role, True)}\n", escape(text)
        if role == TRAINED_ROLE and body:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END, "\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(parts), spans


def read_back(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation."""
    return [(unescape(role, True), unescape(text)) for role, text in _TURN.findall(formatted)]


def align(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> tuple[np.ndarray, list]:
    """Loss mask over tokens, and the characters under it inside each span (token ranges, clipped)."""
    mask, covered = np.zeros(len(starts), bool), []
    for start, end in spans:
        first = int(np.searchsorted(ends, start, "right"))
        last = int(np.searchsorted(starts, end, "left"))
        mask[first:last] = True
        at = None
        for s, e in zip(starts[first:last].tolist(), ends[first:last].tolist(), strict=True):
            s, e = max(s, start), min(e, end)
            if at is not None and s <= at[1]:  # tokens that share a character, or meet
                at[1] = max(at[1], e)
            else:
                at = [s, e]
                covered.append(at)
    return mask, [tuple(x) for x in covered]


def _tokenizer(vocabulary: str) -> Tokenizer:
    if vocabulary not in _tokenizers:
        tokenizer = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        tokenizer.encode_special_tokens = True
        tokenizer.post_processor = ByteLevel(trim_offsets=False)  # every character belongs to a token
        _tokenizers[vocabulary] = tokenizer
    return _tokenizers[vocabulary]


def conversations_by_turn(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, turns): the turns of each conversation in order."""
    turn = F.struct(F.col("turn").cast("long").alias("turn"),
                    F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                    F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return turns.select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t")).groupBy("conv_id").agg(
        F.sort_array(F.collect_list("t")).alias("turns"))


def format_chats(turns: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Per conversation: formatted text, tokens with offsets, loss mask and spans under it."""

    lean_batches(turns.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(vocabulary)
        span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
        for batch in batches:
            for k in range(0, batch.num_rows, BATCH):
                part = batch.slice(k, BATCH)
                texts, spans = zip(*(render([(t["role"], t["text"]) for t in c]) for c in part.column(1).to_pylist()),
                                   strict=True)
                ids, starts, ends, masks, covered = [], [], [], [], []
                for encoded, loss in zip(tokenizer.encode_batch(list(texts), add_special_tokens=False), spans,
                                         strict=True):
                    offsets = np.array(encoded.offsets, np.int32).reshape(-1, 2)
                    mask, under = align(offsets[:, 0], offsets[:, 1], loss)
                    ids.append(encoded.ids)
                    starts.append(offsets[:, 0])
                    ends.append(offsets[:, 1])
                    masks.append(mask)
                    covered.append([{"start": a, "end": b} for a, b in under])
                ints = pa.list_(pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(texts, pa.string()), pa.array(ids, ints), pa.array(starts, ints),
                     pa.array(ends, ints), pa.array(masks, pa.list_(pa.bool_())), pa.array(covered, pa.list_(span))],
                    names=["conv_id", "formatted", "token_ids", "token_starts", "token_ends", "loss_mask",
                           "loss_spans"])

    return conversations_by_turn(turns).mapInArrow(run, _SCHEMA)


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, read back from the formatted text and the spans under the loss mask."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                turns = read_back(text)
                loss = unescape("".join(text[s["start"]:s["end"]] for s in spans))
                said = "".join(f"{role}\n{body}\n" for role, body in turns)
                rows.append((len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss),
                             hashlib.sha256(loss.encode()).hexdigest(), len(text)))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[
                "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return formatted.select("conv_id", "formatted", "loss_spans").mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
             "formatted_chars long")


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "</s>[INST] ok [/INST]"
    added = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(
        F.col("id") == 0, "user").otherwise(TRAINED_ROLE).alias("role"), F.lit(tricky).alias("text"))
    return digests(format_chats(turns.union(added)))


def _escaped(column: str) -> str:
    out = f"replace({column}, '\\', '\\\\')"
    for c in CONTROLS:
        out = f"replace({out}, '{c}', '{c[0]}\\{c[1:]}')"
    return out


OP4_SQL = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, '{TRAINED_ROLE}', '</s>[INST] ok [/INST]'),
c AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
    coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = '{TRAINED_ROLE}'), '') AS loss,
    sum({len(START) + len(END) + 2} + length({_escaped('role')}) + length(role) - length(replace(role, chr(10), ''))
      + length({_escaped('text')})) AS chars
  FROM t GROUP BY conv_id)
SELECT conv_id, n_turns::BIGINT AS n_turns, sha256(said) AS turns_sha256, length(loss)::BIGINT AS loss_chars,
  sha256(loss) AS loss_sha256, chars::BIGINT AS formatted_chars FROM c
"""
