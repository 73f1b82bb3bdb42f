"""Language identification with segmentation-marginalised unigrams.

Each language is a unigram model over the pieces of a fixed public vocabulary.
A word's probability in a language is the sum over all ways to cut it into
pieces, by the forward algorithm; a text's is the product over its words and
the language's prior.  The language with the largest posterior is predicted and
the posterior is the score.

Training: the piece probabilities come from expectation maximisation (forward
and backward over all words of the sample, in tasks) on a bounded sample,
``SAMPLE_DOCS`` labelled texts of each language, chosen by a hash of the text;
copies of a text count once.  Documents with crc32(doc_id) mod 4 equal to 2 are
held out.  Priors are counted over all training rows.

Scoring covers every whole text.  Words repeat, so a Python worker keeps the
log probabilities of up to ``CACHE_WORDS`` words; the forward recursion runs
over batches of new words of one length at a time, all languages at once.
Words of more than ``BATCHED`` letters (scripts without blanks) take one pass
each, with rescaled sums, and are not kept.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.util import ship_package
from .common import among_smallest, stored, text_or_empty
from .tokenization import tokenizer_path

VOCABULARY = "piece_bpe_32k.model"
SAMPLE_DOCS = 1500
EM_ROUNDS = 3
SMOOTHING = 0.05  # pseudo count of every piece
UNKNOWN = 1e-7  # probability of a letter that is no piece, in every language
BATCHED = 32  # letters of the longest words that are worked on in batches; probabilities of such need no scaling
RESCALED = 16  # letters between two rescalings of a longer word
CACHE_WORDS = 250_000
SLICE_ROWS = 256  # texts scored together
HELD_OUT = 2
MIN_SCORE = 0.5  # the pipeline stage rejects texts below



def _ranges(codes: Iterable[int]) -> str:
    """A regular expression's ranges of ascending code points."""
    out: list[list[int]] = []
    for c in codes:
        if out and out[-1][1] == c - 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in out)


def _patterns(end: int) -> tuple[re.Pattern, re.Pattern]:
    """Words, and what may stand in one, in texts of code points below ``end``: letters, and the marks that combine with them.

    The letters are listed, not excluded: up to U+FFFF a character is looked up in one table.
    """
    letter = "[%s]" % _ranges(c for c in range(end) if chr(c).isalpha())
    mark = "[%s]" % _ranges(c for c in range(end) if unicodedata.category(chr(c))[0] == "M")
    return re.compile(f"{letter}+(?:{mark}+{letter}*)*"), re.compile(f"(?:{letter}|{mark})*")


_LETTERS, _BODY = _patterns(0x110000)
_BASIC_LETTERS, _ = _patterns(0x10000)
_BEYOND = re.compile("[\U00010000-\U0010ffff]")
_START = "▁"


def words_of(text: str) -> list[str]:
    """Lower-cased runs of letters and their marks, each with the word start mark."""
    lower = text.lower()
    letters = _BASIC_LETTERS if lower.isascii() or not _BEYOND.search(lower) else _LETTERS
    return [_START + w for w in letters.findall(lower)]


def pieces_of(path: str) -> list[str]:
    """Vocabulary pieces that can occur in a word: lower-case letters and marks, with or without the start mark."""
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=path)
    found = set()
    for k in range(sp.get_piece_size()):
        p = sp.id_to_piece(k)
        body = p[1:] if p.startswith(_START) else p
        if p and body == body.lower() and _BODY.fullmatch(body):
            found.add(p)
    return sorted(found)


def _reach(ids: dict[str, int]) -> int:
    return max(map(len, ids), default=1)


class Steps:
    """The pieces as a tree of letters: a sorted table of steps ``(node, letter)`` that many words walk at once."""

    def __init__(self, ids: dict[str, int]):
        import numpy as np

        steps: dict[int, int] = {}
        found = [-1]  # the piece that ends at a node
        for piece, k in ids.items():
            node = 0
            for c in piece:
                node = steps.setdefault(node * 0x110000 + ord(c), len(found))
                if node == len(found):
                    found.append(-1)
            found[node] = k
        # One step more, that no letter takes, so that a table of none can be searched.
        keys, nodes = np.array([*steps, -1], np.int64), np.array([*steps.values(), 0], np.int64)
        order = np.argsort(keys)
        self.none, self._keys, self._nodes, self._found = len(ids), keys[order], nodes[order], np.array(found, np.int64)

    def cuts(self, words: list[str]):
        """For words of one length n: ``{(i, j): piece numbers}`` by j, then i; -1 where ``word[i:j]`` is no piece."""
        import numpy as np

        n, width, out = len(words[0]), len(words), {}
        letters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
        letters = np.ascontiguousarray(letters.reshape(width, n).T).ravel().astype(np.int64)
        at, node = np.arange(n * width), np.zeros(n * width, np.int64)  # starts still on their way, by place in the word
        for size in range(1, n + 1):
            left = np.searchsorted(at, (n - size + 1) * width)
            step = node[:left] * 0x110000 + letters[at[:left] + (size - 1) * width]
            place = np.minimum(np.searchsorted(self._keys, step), len(self._keys) - 1)
            known = self._keys[place] == step
            at, node = at[:left][known], self._nodes[place[known]]
            if size > 1 and not len(at):
                break
            got = np.full((n - size + 1, width), -1, np.int64)
            got.ravel()[at] = self._found[node]
            if size == 1:
                got[got < 0] = self.none  # a single letter is always readable
            for i in np.flatnonzero((got >= 0).any(axis=1)).tolist():
                out[i, i + size] = got[i]
        return dict(sorted(out.items(), key=lambda x: x[0][::-1]))


def _cuts_before(word: str, j: int, ids: dict[str, int], reach: int) -> list[tuple[int, int]]:
    """``(i, piece number)`` of the pieces of a word that end at ``j``."""
    none = len(ids)
    found = ((i, ids.get(word[i:j], none if i + 1 == j else -1)) for i in range(max(0, j - reach), j))
    return [(i, k) for i, k in found if k >= 0]


def _long_forward(word: str, ids: dict[str, int], table, reach: int):
    """``forward`` of one word of any length: only the last ``reach`` sums are kept, and rescaled on the way."""
    import numpy as np

    ring, scale = np.zeros((reach, table.shape[1])), np.zeros(table.shape[1])
    ring[0] = 1.0
    for j in range(1, len(word) + 1):
        at, pieces = zip(*_cuts_before(word, j, ids, reach), strict=True)
        ring[j % reach] = (ring[np.array(at) % reach] * table[list(pieces)]).sum(axis=0)
        if j % RESCALED == 0:
            most = ring.max(axis=0)
            ring /= most
            scale += np.log(most)
    return np.log(ring[len(word) % reach]) + scale


def _long_counts(word: str, weight: float, ids: dict[str, int], logs: list[float], reach: int, out) -> None:
    """``expected_counts`` of one word of any length, by logarithms; added to ``out``."""

    def added(values):
        most = max(values)
        return most + math.log(sum(math.exp(v - most) for v in values))

    n = len(word)
    cuts = [_cuts_before(word, j, ids, reach) for j in range(n + 1)]
    alpha, beta = [0.0] * (n + 1), [-math.inf] * n + [0.0]
    for j in range(1, n + 1):
        alpha[j] = added([alpha[i] + logs[k] for i, k in cuts[j]])
    for j in range(n, 0, -1):
        if beta[j] == -math.inf:
            continue
        for i, k in cuts[j]:
            beta[i] = added([beta[i], logs[k] + beta[j]])
            if k < len(ids):
                out[k] += weight * math.exp(alpha[i] + logs[k] + beta[j] - alpha[n])


def _by_length(words: Iterable[str]) -> dict[int, list[str]]:
    out: dict[int, list[str]] = {}
    for w in words:
        out.setdefault(len(w), []).append(w)
    return out


def forward(words: list[str], ids: dict[str, int], table, steps: Steps | None = None):
    """Log probability of each word in each language: ``[words, languages]``.

    ``table``: probabilities ``[pieces + 1, languages]``, the last row for unknown letters.
    """
    import numpy as np

    steps = steps or Steps(ids)
    out = np.zeros((len(words), table.shape[1]))
    place, reach = {w: k for k, w in enumerate(words)}, _reach(ids)
    padded = np.vstack([table, np.zeros((1, table.shape[1]))])  # index -1: no piece
    for n, group in _by_length(place).items():
        if n > BATCHED + 1:
            for w in group:
                out[place[w]] = _long_forward(w, ids, table, reach)
            continue
        alpha = [np.ones((len(group), table.shape[1]))] + [np.zeros((len(group), table.shape[1])) for _ in range(n)]
        for (i, j), got in steps.cuts(group).items():
            alpha[j] += alpha[i] * padded[got]
        out[[place[w] for w in group]] = np.log(alpha[n])
    return out


def expected_counts(counts: dict[str, int], ids: dict[str, int], probs, steps: Steps | None = None):
    """Expected piece counts over all segmentations of all words, for one language."""
    import numpy as np

    steps = steps or Steps(ids)
    out, padded, reach = np.zeros(len(ids) + 1), np.append(probs, 0.0), _reach(ids)
    logs: list[float] = []
    for n, group in _by_length(counts).items():
        if n > BATCHED + 1:
            logs = logs or np.log(probs).tolist()
            for w in group:
                _long_counts(w, counts[w], ids, logs, reach, out)
            continue
        cuts = steps.cuts(group)
        weight = np.array([counts[w] for w in group], float)
        alpha = [np.ones(len(group))] + [np.zeros(len(group)) for _ in range(n)]
        beta = [np.zeros(len(group)) for _ in range(n)] + [np.ones(len(group))]
        for (i, j), got in cuts.items():
            alpha[j] += alpha[i] * padded[got]
        for (i, j), got in sorted(cuts.items(), key=lambda x: (-x[0][0], x[0][1])):
            beta[i] += padded[got] * beta[j]
        for (i, j), got in cuts.items():
            known = got >= 0
            np.add.at(out, got[known], (weight * alpha[i] * padded[got] * beta[j] / alpha[n])[known])
    return out[:-1]


def fit(words: DataFrame, pieces: list[str], rounds: int = EM_ROUNDS):
    """``(languages, table)`` from a written table ``(lang, word, n)``.

    Each round's expected counts are summed in tasks; a row a piece and language comes back.
    """
    import numpy as np

    spark = words.sparkSession
    langs = sorted(r[0] for r in words.select("lang").distinct().collect())
    table = np.full((len(pieces) + 1, max(1, len(langs))), 1.0 / max(1, len(pieces)))
    table[-1] = UNKNOWN
    for _ in range(rounds if langs else 0):
        told = spark.sparkContext.broadcast(table)

        def expect(batches: Iterator, told=told) -> Iterator:
            import pandas as pd

            ids, place = {p: k for k, p in enumerate(pieces)}, {x: k for k, x in enumerate(langs)}
            steps = Steps(ids)
            sums = np.zeros((len(pieces), len(langs)))
            for pdf in batches:
                for lang, part in pdf.groupby("lang"):
                    column = place[lang]
                    sums[:, column] += expected_counts(dict(zip(part["word"], part["n"], strict=True)), ids, told.value[:, column], steps)
            piece, lang = np.nonzero(sums)
            yield pd.DataFrame({"piece": piece, "lang": lang, "c": sums[piece, lang]})

        # Rounded, so that the order of additions leaves no trace.
        got = words.mapInPandas(expect, "piece int, lang int, c double").groupBy("piece", "lang").agg(F.round(F.sum("c"), 6).alias("c")).toPandas()
        counted = np.full((len(pieces), len(langs)), SMOOTHING)
        counted[got["piece"].to_numpy(), got["lang"].to_numpy()] += got["c"].to_numpy()
        table[:-1] = counted / counted.sum(axis=0)
        told.destroy()
    return langs, table


def held_out(doc_id: str = "doc_id") -> Column:
    """crc32 of the doc_id as text, mod 4, is 2; never for a null doc_id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == HELD_OUT, F.lit(False))


class Model:
    """Piece probabilities, languages and priors; scores texts with a bounded cache of words."""

    def __init__(self, pieces: list[str], langs: list[str], table, priors):
        self.pieces, self.langs, self.table, self.priors = pieces, langs, table, priors
        self._ids: dict[str, int] | None = None

    def _ready(self):
        import numpy as np

        if self._ids is None:
            self._ids = {p: k for k, p in enumerate(self.pieces)}
        self._reach, self._steps = _reach(self._ids), Steps(self._ids)
        self._rows: dict[str, int] = {}
        self._logs = np.empty((0, len(self.langs)))
        self._used = 0

    def __getstate__(self):
        return {"pieces": self.pieces, "langs": self.langs, "table": self.table, "priors": self.priors, "_ids": None}

    def _learn(self, words: set[str]) -> None:
        import numpy as np

        new = [w for w in words if w not in self._rows]
        if not new:
            return
        if self._used + len(new) > max(CACHE_WORDS, len(words)):
            self._rows, self._used, new = {}, 0, list(words)
        logs = forward(new, self._ids, self.table, self._steps)
        need = self._used + len(new)
        if need > len(self._logs):
            grown = np.empty((max(need, min(2 * len(self._logs), CACHE_WORDS), 1 << 14), len(self.langs)))
            grown[: self._used] = self._logs[: self._used]
            self._logs = grown
        self._logs[self._used : need] = logs
        self._rows.update(zip(new, range(self._used, need), strict=True))
        self._used = need

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """``(language, posterior)`` per text; ``und`` and 0 without a letter or without a language to choose."""
        import numpy as np

        if self._ids is None:
            self._ready()
        cut = [words_of(t) if t else [] for t in texts]
        if self.langs:
            self._learn({w for ws in cut for w in ws if len(w) <= BATCHED + 1})
        out = []
        for ws in cut:
            if not ws or not self.langs:
                out.append(("und", 0.0))
                continue
            long = [w for w in ws if len(w) > BATCHED + 1]
            short = [w for w in ws if len(w) <= BATCHED + 1] if long else ws
            rows = np.fromiter(map(self._rows.__getitem__, short), np.int64, len(short))
            logs = self._logs[rows].sum(axis=0) + self.priors
            for w in long:
                logs = logs + _long_forward(w, self._ids, self.table, self._reach)
            best = int(logs.argmax())
            out.append((self.langs[best], float(1.0 / np.exp(logs - logs[best]).sum())))
        return out


def train(docs: DataFrame, vocabulary: str | None = None, sample_docs: int = SAMPLE_DOCS) -> Model:
    """A model from the labelled rows of ``docs`` that are not held out (text and lang only).

    The sample is chosen by text, so null or repeated doc_ids make no difference to it.
    """
    import numpy as np

    ship_package(docs.sparkSession)
    pieces = pieces_of(vocabulary or tokenizer_path(VOCABULARY))
    rows = docs.where(F.col("lang").isNotNull() & ~held_out()).select(F.col("lang").cast("string").alias("lang"), text_or_empty().alias("text"))
    hashed = rows.select("lang", F.xxhash64("text").alias("h"), "text")
    sizes = stored(hashed.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"), F.approx_count_distinct("h").alias("texts")), "languages")
    # Which texts: by hash, thinned out first; then only those are read on.
    few = hashed.select("lang", "h").join(sizes, "lang").where(among_smallest(F.col("h"), sample_docs, F.col("texts"))).select("lang", "h").distinct()
    order = Window.partitionBy("lang").orderBy("h")
    chosen = stored(few.withColumn("k", F.row_number().over(order)).where(F.col("k") <= sample_docs).select("lang", "h"), "sampled-texts")
    some = hashed.join(F.broadcast(chosen), ["lang", "h"], "left_semi")

    def count_words(batches: Iterator) -> Iterator:
        from collections import Counter

        import pandas as pd

        seen: set = set()  # a task reads a text once, however many copies it meets; no more than were chosen
        for pdf in batches:
            for lang, h, text in zip(pdf["lang"], pdf["h"], pdf["text"], strict=True):
                if (lang, h) not in seen:
                    seen.add((lang, h))
                    found = Counter(words_of(text))
                    yield pd.DataFrame({"lang": lang, "h": h, "word": list(found), "n": list(found.values())}).astype({"lang": object, "word": object, "n": "int64"})

    counted = some.mapInPandas(count_words, "lang string, h bigint, word string, n bigint")
    once = counted.groupBy("lang", "h", "word").agg(F.max("n").alias("n"))  # copies met by several tasks
    words = stored(once.groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    langs, table = fit(words, pieces)
    total = {r["lang"]: r["rows"] for r in sizes.collect()}  # one row a language
    priors = np.log(np.array([float(total[x]) for x in langs]) / max(1, sum(total.values()))) if langs else np.zeros(0)
    return Model(pieces, langs, table, priors)


def _parts(batches: Iterator) -> Iterator:
    """Arrow batches in slices, which share their memory."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(at, SLICE_ROWS)


def _scored(docs: DataFrame, carry: list[Column], model: Model) -> DataFrame:
    """``carry`` plus ``lang_pred`` and ``score``."""
    spark = docs.sparkSession
    ship_package(spark)
    told = spark.sparkContext.broadcast(model)

    def predict(batches: Iterator) -> Iterator:
        import pyarrow as pa

        m = told.value
        for part in _parts(batches):
            got = m.predict(part.column(0).to_pylist())
            columns = [*part.columns[1:], pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*part.schema.names[1:], "lang_pred", "score"])

    asked = docs.select(text_or_empty().alias("text"), *carry)
    kept = asked.drop("text").withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)})
    return asked.mapInArrow(predict, kept.schema)


def identify(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)``, one row per row of ``docs``.

    The model only sees the text.  ``lang_pred`` is ``und`` and the score 0 for
    a null text, one without a letter, or when no labelled rows were there to
    learn from.  Rows with a null doc_id are not held out.  Repeated rows are
    scored alike; other columns are not read; an empty table gives an empty result.
    """
    model = train(docs, vocabulary)
    return _scored(docs, [F.col("doc_id"), held_out().alias("held_out")], model).select("doc_id", "held_out", "lang_pred", "score")


def keep_known(docs: DataFrame, vocabulary: str | None = None, min_score: float = MIN_SCORE) -> DataFrame:
    """Pipeline stage: documents of a known language.

    Rejected are texts without a letter (``und``) and those with a posterior below ``min_score``.
    All columns are returned as they are.
    """
    model = train(docs, vocabulary)
    spark = docs.sparkSession
    ship_package(spark)
    told = spark.sparkContext.broadcast(model)
    text = [c.lower() for c in docs.columns].index("text")

    def choose(batches: Iterator) -> Iterator:
        import pyarrow as pa

        m = told.value
        for part in _parts(batches):
            got = m.predict(part.column(text).to_pylist())
            yield part.filter(pa.array([g[0] != "und" and g[1] >= min_score for g in got], pa.bool_()))

    return docs.mapInArrow(choose, docs.schema)
