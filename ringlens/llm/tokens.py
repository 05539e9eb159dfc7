"""Token counts of a unigram tokenizer without its tokens: count-only Viterbi."""
from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringlens.llm.common import whole

#: What stands for a blank, and stands before every text.
BLANK = "▁"
#: Score of an unknown character below the smallest score of the vocabulary.
UNKNOWN_PENALTY = 10.0
#: Counts kept by a task, of stretches up to this length.
CACHE, CACHED_LENGTH = 1 << 20, 64


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with scores; ``apart`` if stretches between blanks can be counted apart.

    That holds if blanks only begin pieces, so each change to a blank ends a piece on every
    path, and if scores are whole numbers, whose sums don't depend on what stands before.
    """

    pieces: tuple[tuple[str, float], ...]

    @property
    def apart(self) -> bool:
        lead = re.compile(f"{BLANK}*[^{BLANK}]*")
        return all(lead.fullmatch(p) and float(s).is_integer() for p, s in self.pieces)


def read_vocabulary(path: str) -> Vocabulary:
    """The pieces and scores of a sentencepiece model file, read on the driver."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return Vocabulary(tuple((model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())))


class Counter:
    """Counts the pieces of the best-scored segmentation.

    The automaton gives all pieces that end at a character, longest first; a later candidate
    replaces the best path to that place only if its score is greater, so of equal scores the
    one with the longest last piece stays. A character without a piece of its own may also be
    unknown, at a score below all others; it counts as its UTF-8 bytes.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary.pieces:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min((s for _, s in vocabulary.pieces), default=0.0) - UNKNOWN_PENALTY
        self.stretch = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+" if vocabulary.apart else r"(?s).+")
        self.known: dict[str, int] = {}

    def best(self, text: str) -> int:
        scores, counts, unknown = [0.0], [0], self.unknown
        at = 0

        def pass_over(end: int) -> None:
            """Places whose character no piece ends at: reached as an unknown one."""
            while len(scores) <= end:
                scores.append(scores[-1] + unknown)
                counts.append(counts[-1] + len(text[len(scores) - 2].encode("utf-8", "surrogatepass")))

        single, best, count = False, None, 0

        def close(end: int) -> None:
            nonlocal single, best, count
            if not single:
                lone = scores[end - 1] + unknown
                if best is None or lone > best:
                    best = lone
                    count = counts[end - 1] + len(text[end - 1].encode("utf-8", "surrogatepass"))
            scores.append(best)
            counts.append(count)
            single, best = False, None

        for last, (length, score) in self.automaton.iter(text):
            end = last + 1
            if end != at:
                if at:
                    close(at)
                pass_over(end - 1)
                at = end
            candidate = scores[end - length] + score
            if best is None or candidate > best:
                best, count = candidate, counts[end - length] + 1
            if length == 1:
                single = True
        if at:
            close(at)
        pass_over(len(text))
        return counts[-1]

    def count(self, text: str) -> int:
        if not text:
            return 0
        known, total = self.known, 0
        for part in self.stretch.findall(BLANK + text.replace(" ", BLANK)):
            n = known.get(part)
            if n is None:
                n = self.best(part)
                if len(part) <= CACHED_LENGTH:
                    if len(known) >= CACHE:
                        known.clear()
                    known[part] = n
            total += n
        return total


def token_counts(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", id: str = "doc_id") -> DataFrame:
    """``id, n_tokens`` of every row: how many tokens the tokenizer makes of the whole text.

    Null and empty texts have none. Null and repeated ids are rows of their own, an empty
    table gives an empty result, other columns are not read. The vocabulary travels with the
    tasks (its size doesn't depend on the input); each task builds its automaton once.
    """
    kind = docs.schema[id].dataType.simpleString()

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = Counter(vocabulary)
        for batch in batches:
            yield batch[["id"]].assign(n_tokens=[counter.count(t) for t in batch["text"]])

    return docs.select(F.col(id).alias("id"), whole(text).alias("text")).mapInPandas(
        counted, f"id {kind}, n_tokens bigint"
    )
