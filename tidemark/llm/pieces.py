"""SentencePiece encoding and decoding by a shared-prefix Viterbi search.

A text is cut into marked words: a run of spaces with the word behind it. No
piece of a supported model reaches across such a cut, so words are encoded on
their own, each distinct word once. The distinct words are sorted, which puts
them into the depth-first order of their trie: the forward scores of a prefix are
those of the trie node, and a word only computes what lies below the prefix that
it shares with the one before.

Forward scores are sums of piece scores. In a unigram model any pieces may follow
each other. In a BPE model a transition is admissible only if merging the two
pieces' characters by rank gives these two pieces again; the admissible path is
then the result of BPE itself.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
CACHED_WORDS = 300_000
SIGNS = ".,;:!?*#$%&|)\"'"
PART_CHARS = 1_000_000
FALLBACK = -1
SHARED: dict[str, "Vocabulary"] = {}


class Vocabulary:
    """Pieces, scores and byte fallback of a SentencePiece model."""

    def __init__(self, model: bytes):
        proto = sentencepiece_model_pb2.ModelProto.FromString(model)
        kinds = proto.trainer_spec
        self.bpe = kinds.model_type == kinds.BPE
        norm = proto.normalizer_spec
        if not (self.bpe or kinds.model_type == kinds.UNIGRAM) or norm.precompiled_charsmap or norm.remove_extra_whitespaces \
                or not norm.escape_whitespaces or kinds.treat_whitespace_as_suffix or not norm.add_dummy_prefix:
            raise ValueError("only unigram and BPE models with a dummy prefix and no text normalisation are supported")
        piece = sentencepiece_model_pb2.ModelProto.SentencePiece
        self.ids: dict[str, int] = {}
        self.scores = [p.score for p in proto.pieces]
        self.bytes_of: list[bytes] = []
        self.byte_ids = [-1] * 256
        self.unknown = 0
        for i, p in enumerate(proto.pieces):
            text = p.piece.replace(SPACE, " ")
            if p.type == piece.USER_DEFINED:
                raise ValueError("user-defined pieces are not supported")
            if p.type == piece.BYTE:
                self.byte_ids[int(p.piece[3:5], 16)] = i
                self.bytes_of.append(bytes([int(p.piece[3:5], 16)]))
            elif p.type in (piece.CONTROL, piece.UNUSED):
                self.bytes_of.append(b"")
            elif p.type == piece.UNKNOWN:
                self.unknown = i
                self.bytes_of.append(" ⁇ ".encode())
            else:
                self.ids[text] = i
                self.bytes_of.append(text.encode())
        if any(" " in p.lstrip(" ") for p in self.ids):
            raise ValueError("a piece reaches across a space")
        self.texts = {i: p for p, i in self.ids.items()}
        self.characters = {c for p in self.ids for c in p}
        self.neighbours = {a + b for p in self.ids for a, b in zip(p, p[1:])}
        self.separator = next(c for c in map(chr, range(0x110000)) if c not in self.characters)
        self.unknown_score = min((self.scores[i] for i in self.ids.values()), default=0.0) - UNKNOWN_PENALTY
        # Line feeds also end a word where no piece holds them.
        self.line_ends = "\n" not in self.characters
        self.cutter = re.compile(r"\n[^ \n]*| +[^ \n]*|[^ \n]+" if self.line_ends else r" +[^ ]*|[^ ]+")
        self.key = hashlib.sha256(model).hexdigest()
        self.forget()

    def forget(self) -> None:
        """Drop what is only kept to save time."""
        self.automaton: ahocorasick.Automaton | None = None
        self.steps: dict[int, list[tuple[float, str, str]]] = {}
        self.follows: dict[int, bool] = {}
        self.cache: dict[str, bytes] = {}

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, "rb") as f:
            return cls(f.read())

    def __getstate__(self) -> dict:
        return {**self.__dict__, "automaton": None, "steps": {}, "follows": {}, "cache": {}}

    def shared(self) -> Vocabulary:
        """This process's copy of the vocabulary, whose caches later tasks go on using."""
        if self.key not in SHARED:
            SHARED.clear()
            SHARED[self.key] = self
        return SHARED[self.key]

    def merges(self, piece: int) -> list[tuple[float, str, str]]:
        """The states of BPE on one piece: the score of the next merge, the last part, the first part."""
        if piece not in self.steps:
            parts, states = list(self.texts[piece]), []
            while True:
                best = max(((self.scores[self.ids[a + b]], -i) for i, (a, b) in enumerate(zip(parts, parts[1:]))
                            if a + b in self.ids), default=None)
                states.append((best[0] if best else -np.inf, parts[-1], parts[0]))
                if best is None:
                    break
                i = -best[1]
                parts[i:i + 2] = [parts[i] + parts[i + 1]]
            self.steps[piece] = states if len(parts) == 1 else []
        return self.steps[piece]

    def admissible(self, before: int, piece: int) -> bool:
        """Whether ``piece`` may follow ``before`` (FALLBACK: the start, or a character without a piece).

        BPE merges the best-scored pair first and the leftmost among equals. The
        two pieces stand next to each other in its result if no merge across
        their border is ever due while each is put together on its own.
        """
        right = self.merges(piece)
        if not right or before == FALLBACK:
            return bool(right)
        left = self.merges(before)
        i = j = 0
        while True:
            due_left, due_right = left[i][0], right[j][0]
            across = self.ids.get(left[i][1] + right[j][2])
            if across is not None and self.scores[across] > due_left and self.scores[across] >= due_right:
                return False
            if due_left == due_right == -np.inf:
                return True
            if due_left >= due_right:
                i += 1
            else:
                j += 1

    def matcher(self) -> ahocorasick.Automaton:
        """Finds every piece that ends at each character."""
        automaton = ahocorasick.Automaton()
        for text, i in self.ids.items():
            automaton.add_word(text, (len(text), i))
        automaton.make_automaton()
        return automaton

    def encode_words(self, words: Iterable[str]) -> Iterator[tuple[str, array]]:
        """The piece ids of each of the ``words``, visited in the order of their trie."""
        scores, bpe, follows, admissible = self.scores, self.bpe, self.follows, self.admissible
        if self.automaton is None:
            self.automaton = self.matcher()
        ordered = sorted(words)
        # All pieces of all words in one pass; none reaches across the separator.
        ends = self.automaton.iter(self.separator.join(ordered))
        none = (1 << 62, (0, 0))
        at, (length, piece) = next(ends, none)
        score, last, back = [0.0], [FALLBACK], [0]  # of each prefix on the current path
        previous = ""
        offset = 0  # of the word in the joined text
        for word in ordered:
            depth = 0
            for a, b in zip(previous, word):
                if a != b:
                    break
                depth += 1
            del score[depth + 1:], last[depth + 1:], back[depth + 1:]
            while at < offset + depth:
                at, (length, piece) = next(ends, none)
            for end in range(depth + 1, len(word) + 1):
                best, choice, origin = -np.inf, FALLBACK, end - 1
                while at == offset + end - 1:
                    begin = end - length
                    if not bpe:
                        if score[begin] + scores[piece] > best:
                            best, choice, origin = score[begin] + scores[piece], piece, begin
                    elif choice == FALLBACK:  # only one path into a prefix is admissible
                        pair = last[begin] * 0x1000000 + piece
                        allowed = follows.get(pair)
                        if allowed is None:
                            allowed = follows[pair] = admissible(last[begin], piece)
                        if allowed:
                            best, choice, origin = score[begin] + scores[piece], piece, begin
                    at, (length, piece) = next(ends, none)
                if choice == FALLBACK:
                    best = score[end - 1] + self.unknown_score
                score.append(best)
                last.append(choice)
                back.append(origin)
            path, end = [], len(word)
            while end:
                if last[end] != FALLBACK:
                    path.append(last[end])
                else:
                    path += [self.byte_ids[b] if self.byte_ids[b] >= 0 else self.unknown
                             for b in reversed(word[end - 1].encode())]
                end = back[end]
            path.reverse()
            yield word, array("i", path)
            previous = word
            offset += len(word) + 1

    def words_of(self, text: str | None) -> list[str]:
        """The marked words of a text, those of one space without it.

        A word of another kind keeps its spaces, or begins with the line feed
        that stands before it.
        """
        if not text:
            return []
        if self.line_ends:
            words = text.replace("\n", " \n").split(" ")
            if "" not in words:
                return words
        return [w[1:] if w[0] == " " and w[1:2] not in ("", " ", "\n") else w for w in self.cutter.findall(" " + text)]

    def learn(self, words: Iterable[str]) -> None:
        """Encode new words; the signs at a word's end apart where no piece joins them to the word."""
        cuts: dict[str, tuple[str, str]] = {}
        todo = set()
        for word in words:
            whole = word if word[0] in " \n" else " " + word
            head = whole.rstrip(SIGNS)
            if len(head) == len(whole) or head in ("", " ") or head[-1] + whole[len(head)] in self.neighbours:
                head = whole
            tail = whole[len(head):]
            cuts[word] = (head, tail)
            todo.add(head)
            if tail:
                todo.add(tail)
        ids = {word: out.tobytes() for word, out in self.encode_words(todo)}
        self.cache.update((word, ids[head] + ids[tail] if tail else ids[head]) for word, (head, tail) in cuts.items())

    def encode(self, texts: list[str | None]) -> list[np.ndarray | None]:
        """int32 piece ids of each text; None for a null text."""
        for kept in (self.cache, self.follows):
            if len(kept) > CACHED_WORDS:
                kept.clear()
        documents = [self.words_of(t) for t in texts]
        new: set[str] = set()
        for words in documents:
            new.update(words)
        self.learn(new.difference(self.cache))
        known = self.cache.__getitem__
        return [None if t is None else np.frombuffer(b"".join(map(known, words)), dtype=np.int32)
                for t, words in zip(texts, documents)]

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.bytes_of.__getitem__, ids)).decode(errors="replace")
        return text[1:] if text.startswith(" ") else text


def parts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list]]:
    """The batches' first column and the values of their second one, in parts of bounded size."""
    for batch in batches:
        begin, waiting, values = 0, 0, []
        for i, value in enumerate(batch.column(1)):
            values.append(value.as_py())
            waiting += len(values[-1] or ())
            if waiting >= PART_CHARS or i == batch.num_rows - 1:
                yield batch.column(0).slice(begin, len(values)), values
                begin, waiting, values = i + 1, 0, []


def ids_array(rows: list[np.ndarray | None]) -> pa.Array:
    sizes = np.array([0 if r is None else len(r) for r in rows], dtype=np.int64)
    offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))), type=pa.int32())
    values = np.concatenate([r for r in rows if r is not None] or [np.empty(0, np.int32)])
    return pa.ListArray.from_arrays(offsets, pa.array(values, type=pa.int32()),
                                    mask=pa.array([r is None for r in rows], type=pa.bool_()))


def encode(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text",
           check: bool = False) -> DataFrame:
    """One row per document: ``id_col``, ``ids`` (array<int>), ``n_tokens``.

    ``check`` decodes each document's ids again and adds ``round_trip``, whether
    that gave its text.

    Defined cases: a null text gives null ids and 0 tokens, an empty one no ids;
    characters without a piece become their UTF-8 byte pieces, as does the space
    mark itself where a text holds it, so that decoding is exact; strings of
    control pieces are ordinary text; repeated rows give repeated rows.
    """
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = vocabulary.shared()
        for names, texts in parts_of(batches):
            ids = shared.encode(texts)
            out = [names, ids_array(ids)]
            if check:
                out.append(pa.array([t is None if i is None else shared.decode(i.tolist()) == t
                                     for t, i in zip(texts, ids)], type=pa.bool_()))
            yield pa.RecordBatch.from_arrays(out, names=["id", "ids", "round_trip"][:len(out)])

    schema = f"id {own.schema['id'].dataType.simpleString()}, ids array<int>" + (", round_trip boolean" if check else "")
    coded = own.mapInArrow(code, schema)
    return coded.select(F.col("id").alias(id_col), "ids", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_tokens"),
                        *(["round_trip"] if check else []))


def decode(coded: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per input row: ``id_col`` and the decoded ``text`` (null for null ids)."""
    own = coded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for names, rows in parts_of(batches):
            texts = [None if r is None else vocabulary.decode(r) for r in rows]
            yield pa.RecordBatch.from_arrays([names, pa.array(texts, type=pa.string())], names=["id", "text"])

    read_back = own.mapInArrow(read, f"id {own.schema['id'].dataType.simpleString()}, text string")
    return read_back.select(F.col("id").alias(id_col), "text")
