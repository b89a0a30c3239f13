"""Token counts of a unigram tokenizer, without making the tokens.

A whole text is marked as SentencePiece does without normalisation: the word mark in front of
it and for every space, runs kept; other white space is characters like any. Taken by words
instead, white space is left out and each word gets a mark. An Aho-Corasick automaton enumerates the vocabulary pieces that end at every character, and
a Viterbi pass keeps just the best score and its number of pieces. The tie rules are the
tokenizers library's: of equal scores the earlier start, so the longer piece, wins; a
character that no single-character piece covers is unknown at 10 below the lowest score;
unknown characters in a row are one token, or with byte fallback one per byte.

Texts are cut into units that are counted once each: before a mark that follows another
character, and around newlines, where no piece and no run of unknown characters can span the cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from rowmill.llm.common import filled, keyed_texts, offsets_of, split_words, sums, text_slices

WORD_MARK = "▁"
#: What an unknown character scores below the lowest piece.
UNKNOWN_PENALTY = 10.0
#: Words that a task's table holds at most, when a batch begins.
MAX_WORDS = 400_000
#: Characters of a word in that table, at most; longer ones are counted each time.
MAX_KEPT = 1_000


def read_vocabulary(path: str) -> list[tuple[str, float]]:
    """The ordinary pieces of a SentencePiece model and their scores."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [
        (model.id_to_piece(i), model.get_score(i))
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]


class PieceCounter:
    """(pieces, best score) of words, each distinct word counted once."""

    def __init__(self, vocabulary: list[tuple[str, float]], byte_fallback: bool = False):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if piece and not self.automaton.exists(piece):
                self.automaton.add_word(piece, (len(piece), float(score)))
        if vocabulary:
            self.automaton.make_automaton()
        self.empty = not len(self.automaton)
        self.unknown = min((s for _, s in vocabulary), default=0.0) - UNKNOWN_PENALTY
        self.byte_fallback = byte_fallback
        pieces = [piece for piece, _ in vocabulary]
        # an unknown mark could continue a run of unknown characters, which is one token
        self.cut_marks = (byte_fallback or WORD_MARK in pieces) and not any(
            WORD_MARK in piece.lstrip(WORD_MARK) for piece in pieces
        )
        self.cut_lines = byte_fallback and not any("\n" in piece for piece in pieces)
        self.known: dict[str, tuple[int, float]] = {}

    def count(self, word: str) -> tuple[int, float]:
        n = len(word)
        scores, counts, open_run = [0.0] + [None] * n, [0] * (n + 1), [False] * (n + 1)
        at, single = 0, False
        unknown, fallback = self.unknown, self.byte_fallback

        def close(end: int) -> None:
            """Every piece that ends there is seen; what is left is the unknown character."""
            if single:
                return
            score = scores[end - 1] + unknown
            if scores[end] is None or score > scores[end]:
                scores[end] = score
                if fallback:
                    counts[end] = counts[end - 1] + len(word[end - 1].encode())
                else:
                    counts[end] = counts[end - 1] + (not open_run[end - 1])
                open_run[end] = True

        for last, (length, score) in () if self.empty else self.automaton.iter(word):
            while at < last:
                at += 1
                close(at)
                single = False
            end = last + 1
            single |= length == 1
            score += scores[end - length]
            # matches come longest first, so an equal score later has to lose
            if scores[end] is None or score > scores[end]:
                scores[end], counts[end] = score, counts[end - length] + 1
        while at < n:
            at += 1
            close(at)
            single = False
        return counts[n], scores[n]

    def table(self, marked: list[str]) -> list[tuple[int, float]]:
        if len(self.known) > MAX_WORDS:
            self.known = {}
        known, count = self.known, self.count
        out = []
        for word in marked:
            found = known.get(word)
            if found is None:
                found = count(word.replace(" ", WORD_MARK))
                if len(word) <= MAX_KEPT:
                    known[word] = found
            out.append(found)
        return out

    def units(self, texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
        """The marked texts cut into units, marks as spaces: (offsets per text, flat units)."""
        texts = pc.replace_substring(filled(texts), WORD_MARK, " ").cast(pa.string())
        texts = pc.if_else(
            pc.equal(pc.binary_length(texts), 0), "", pc.binary_join_element_wise(" ", texts, "")
        )
        bounds = offsets_of(texts)
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
        bounds = bounds - bounds[0]
        first = np.zeros(len(data), bool)
        if self.cut_marks:
            mark = data == ord(" ")
            first[1:] |= mark[1:] & ~mark[:-1]
        if self.cut_lines:
            line = data == ord("\n")
            first |= line
            first[1:] |= line[:-1]
        first[bounds[:-1][np.diff(bounds) > 0]] = True
        starts = np.flatnonzero(first)
        places = np.append(starts, len(data)).astype(np.int32)
        flat = pa.StringArray.from_buffers(len(starts), pa.py_buffer(places), pa.py_buffer(data))
        return np.searchsorted(starts, bounds), flat

    def totals(self, ends: np.ndarray, flat: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(pieces, score) of each text from its marked words or units."""
        coded = flat.dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False)
        found = np.array(self.table(coded.dictionary.to_pylist()), np.float64).reshape(-1, 2)
        scores = np.add.reduceat(np.append(found[codes, 1], 0.0), ends[:-1]) * (np.diff(ends) > 0)
        return sums(found[codes, 0].astype(np.int64), ends), scores


@lru_cache(2)
def counter_of(path: str, byte_fallback: bool) -> PieceCounter:
    """One counter per worker process, kept between batches and tasks."""
    return PieceCounter(read_vocabulary(path), byte_fallback)


def token_counts(
    docs: DataFrame, model: str, byte_fallback: bool = False, key: str = "doc_id", text: str = "text",
    whole_text: bool = False,
) -> DataFrame:
    """(doc_id, n_words, n_tokens, score): words (between ASCII white space), pieces and summed
    best scores per row. With ``whole_text`` pieces and scores are those of the whole marked
    text, white space included; else just of its words, each marked, so that white space has none.

    ``model`` is the path of a SentencePiece file, taken as a unigram vocabulary, that every
    executor has. A null or empty text has 0 of each; a null id stays null; repeated rows
    give repeated results; other columns are left out. No shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(model, byte_fallback)
        for part in text_slices(batches):
            ends, words = split_words(part.column("text"))
            if whole_text:
                n_tokens, scores = counter.totals(*counter.units(part.column("text")))
            else:
                n_tokens, scores = counter.totals(ends, pc.binary_join_element_wise(" ", words, ""))
            yield pa.record_batch(
                [
                    part.column("doc_id"), pa.array(np.diff(ends), pa.int64()),
                    pa.array(n_tokens, pa.int64()), pa.array(scores),
                ],
                ["doc_id", "n_words", "n_tokens", "score"],
            )

    return keyed_texts(docs, key, text).mapInArrow(
        run, "doc_id long, n_words long, n_tokens long, score double"
    )
