"""Unigram token counts with a trie shared by all pre-tokens.

A pre-token is a word (a run of characters outside ASCII white space) with the
vocabulary's word mark before it.  Its best segmentation has the highest sum of
piece scores, and of equally good ones the fewest tokens; a character that no
piece covers falls back to its UTF-8 bytes, at a penalty below the lowest score.
The distinct new pre-tokens of a batch are inserted into a trie in sorted order,
so that the current path is all that is kept: the forward score of a prefix is
computed once, from those of the prefixes at which a piece that ends here
begins, for all pre-tokens that share it.  Terminal counts are remembered by the
pre-token's hash.

With ``spaces``, white space has tokens as well: each tab, line end and the like
one, and the blanks that are no word's mark (one blank before a word is; one more
mark begins every text that is not empty) those of their run's best segmentation.

The scores are taken as log probabilities.  The given vocabulary file is one of
byte-pair merges, whose scores are merge ranks and -1e9: the counts are those of
this method over its pieces, not those that the sentencepiece library gives.

Null and empty texts have no tokens.  Repeated rows each get a row; very long
words take time in proportion to their length.  An empty table gives no rows; columns
other than the two named have no influence, whatever their names.
"""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from loglens.llm.tables import table
from loglens.llm.text import SPACED, U, Words, chunks, utf8

MODEL = public_tokenizers.path("piece_bpe_32k.model")
MARK = "▁"
KNOWN = 500_000       # pre-tokens whose counts a task remembers
BATCH_BYTES = 4 << 20   # text whose new pre-tokens share a trie


def load_pieces(path: str = MODEL) -> dict[str, float]:
    """Normal pieces of a vocabulary file and their scores."""
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    special = lambda i: sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)
    return {sp.id_to_piece(i): sp.get_score(i) for i in range(sp.get_piece_size()) if not special(i)}


def piece_trie(pieces: dict[str, float]) -> tuple[list[dict], list]:
    """(children by character, score or None) of each node; node 0 is the root."""
    children, score = [{}], [None]
    for piece, s in pieces.items():
        node = 0
        for ch in piece:
            nxt = children[node].get(ch)
            if nxt is None:
                nxt = children[node][ch] = len(children)
                children.append({})
                score.append(None)
            node = nxt
        score[node] = s
    return children, score


def count_words(words: list[str], children: list[dict], score: list, penalty: float, mark: str = MARK) -> list[int]:
    """The tokens of each word's best segmentation; ``words`` are sorted."""
    root = children[0]
    # By depth of the current path: best score, its token count, and the pieces under way as (node, depth of their start).
    best, count, under = [0.0], [0], [[]]
    path, out = "", []

    def extend(ch: str) -> None:
        depth, top, n = len(best), None, 0
        going = []
        for node, start in under[-1]:
            nxt = children[node].get(ch)
            if nxt is not None:
                going.append((nxt, start))
                s = score[nxt]
                if s is not None:
                    v = best[start] + s
                    if top is None or v > top or v == top and count[start] < n - 1:
                        top, n = v, count[start] + 1
        nxt, alone = root.get(ch), False
        if nxt is not None:
            going.append((nxt, depth - 1))
            s = score[nxt]
            if s is not None:
                alone, v = True, best[-1] + s
                if top is None or v > top or v == top and count[-1] < n - 1:
                    top, n = v, count[-1] + 1
        if not alone:
            v = best[-1] + penalty
            if top is None or v > top:
                top, n = v, count[-1] + len(ch.encode())
        best.append(top)
        count.append(n)
        under.append(going)

    for word in words:
        word = mark + word
        same, most = 0, min(len(path), len(word))
        while same < most and path[same] == word[same]:
            same += 1
        del best[same + 1:], count[same + 1:], under[same + 1:]
        for ch in word[same:]:
            extend(ch)
        path = word
        out.append(count[-1])
    return out


def space_tokens(column, children: list[dict], score: list, penalty: float) -> np.ndarray:
    """The white-space tokens of each row."""
    raw, off = utf8(column)
    rows = np.flatnonzero(np.diff(off))
    out = np.zeros(len(off) - 1, np.int64)
    other = ~SPACED[raw] & (raw != 0x20)
    out += np.diff(np.concatenate([[0], np.cumsum(other)])[off])
    # Runs of blanks: they end with their row.
    blank = raw == 0x20
    head, tail = blank.copy(), blank.copy()
    head[1:] &= ~blank[:-1]
    tail[:-1] &= ~blank[1:]
    head[off[rows]] = blank[off[rows]]
    tail[off[rows + 1] - 1] = blank[off[rows + 1] - 1]
    start, end = np.flatnonzero(head), np.flatnonzero(tail) + 1
    row = np.searchsorted(off, start, "right") - 1
    before_word = end < off[row + 1]
    before_word[before_word] = SPACED[raw[end[before_word]]]
    marks = end - start + (start == off[row]) - before_word
    # A row that begins with other white space has a mark of its own.
    alone = rows[other[off[rows]]]
    row, marks = np.concatenate([row, alone]), np.concatenate([marks, np.ones(len(alone), np.int64)])
    distinct, back = np.unique(marks, return_inverse=True)
    counts = np.array([0 if not n else count_words([MARK * (n - 1)], children, score, penalty)[0] for n in distinct.tolist()], np.int64)
    np.add.at(out, row, counts[back])
    return out


def token_counts(docs: DataFrame, model: str = MODEL, id_col: str = "doc_id", text_col: str = "text", spaces: bool = False) -> DataFrame:
    """(doc_id, n_words, n_tokens) per row; ``spaces`` counts the tokens of white space as well."""
    pieces = load_pieces(model)
    shared = docs.sparkSession.sparkContext.broadcast((*piece_trie(pieces), min(pieces.values()) - 10.0))

    def run(batches):
        children, score, penalty = shared.value
        known, value = np.empty(0, U), np.empty(0, np.int64)
        for batch in chunks(batches, "text", BATCH_BYTES):
            w = Words(batch.column("text"), SPACED, lower=False)
            distinct, first, back = np.unique(w.hash, return_index=True, return_inverse=True)
            at = np.minimum(np.searchsorted(known, distinct), max(0, len(known) - 1))
            old = known[at] == distinct if len(known) else np.zeros(len(distinct), bool)
            new = first[~old]
            text = [w.word(i).decode() for i in new.tolist()]
            order = sorted(range(len(text)), key=text.__getitem__)
            fresh = np.empty(len(new), np.int64)
            fresh[order] = count_words([text[i] for i in order], children, score, penalty)
            counts = np.empty(len(distinct), np.int64)
            counts[old] = value[at[old]]
            counts[~old] = fresh
            if len(known) > KNOWN:
                known, value = distinct, counts
            else:
                h = np.concatenate([known, distinct[~old]])
                by = np.argsort(h)
                known, value = h[by], np.concatenate([value, fresh])[by]
            upto = np.concatenate([[0], np.cumsum(counts[back])])
            tokens = np.diff(upto[w.first])
            if spaces:
                tokens = tokens + space_tokens(batch.column("text"), children, score, penalty)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(w.counts, pa.int64()), pa.array(tokens, pa.int64())],
                                             ["doc_id", "n_words", "n_tokens"])

    own = docs.selectExpr(f"`{id_col}` as doc_id", f"`{text_col}` as text")
    return own.mapInArrow(run, f"doc_id {dict(own.dtypes)['doc_id']}, n_words bigint, n_tokens bigint")


def q_op4(spark, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents", "doc_id", "text"), spaces=True)
