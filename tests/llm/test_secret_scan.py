"""Secret scan: base spans and entropy spans against a plain Python reading."""

import hashlib
import math
import random
import re

from quire.llm import secret_scan as S

from ..conftest import SF001
from . import edge

ASSIGN = re.compile(
    r"((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)


def base(text):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out)


def hot(window):
    counts = [window.count(c) for c in set(window)]
    bits = -sum(c / len(window) * math.log2(c / len(window)) for c in counts)
    digits = sum(c.isdigit() for c in window)
    lower, upper = any("a" <= c <= "z" for c in window), any("A" <= c <= "Z" for c in window)
    hexed = all(c in "0123456789abcdefABCDEF" for c in window)
    return (
        hexed and digits >= S.HEX_DIGITS and (lower or upper) and bits >= S.HEX_BITS - 1e-9
        or lower and upper and digits >= S.MIXED_DIGITS and bits >= S.MIXED_BITS - 1e-9
        or (lower or upper) and digits >= S.PLAIN_DIGITS and bits >= S.PLAIN_BITS - 1e-9
    )


def hot_letters(window):
    counts = [window.count(c) for c in set(window)]
    bits = -sum(c / len(window) * math.log2(c / len(window)) for c in counts)
    low = window.lower()
    return bits >= S.LETTER_BITS - 1e-9 and sum(low[k : k + 2] in S.PAIRS for k in range(len(low) - 1)) <= S.LETTER_PAIRS


def entropy(text):
    out, known = [], base(text)
    for m in re.finditer(S.CANDIDATE, text):
        c = m[0]
        if any(re.search(p, c) for p in S.ALLOW):
            continue
        kind, test = (3, hot) if re.search("[0-9]", c) else (4, hot_letters)
        at = [k for k in range(len(c) - S.WINDOW + 1) if test(c[k : k + S.WINDOW])]
        if at:
            span = (m.start() + at[0], kind, m.start() + at[-1] + S.WINDOW)
            if not any(b[0] <= span[0] and span[2] <= b[2] for b in known):
                out.append(span)
    return out


def told(spans):
    return ",".join(f"{S.KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def check(df):
    texts = {r["doc_id"]: r["text"] or "" for r in df.select("doc_id", "text").collect()}
    for r in S.secrets(df).collect():
        t = texts[r["doc_id"]]
        b = base(t)
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(x[1] == k for x in b) for k in range(3))
        assert r["base_sha256"] == hashlib.sha256(told(b).encode()).hexdigest()
        assert r["spans"] == told(b + entropy(t)), t
        assert (r["n_entropy"], r["n_letters"]) == tuple(f":{r['spans']}".replace(",", ":").split(":").count(k) for k in S.KINDS[3:])
        assert r["letters"] == told(x for x in entropy(t) if x[1] == 4)


def test_supplied_rows(spark):
    check(spark.read.parquet(f"{SF001}/documents.parquet"))


def test_made_up_rows(spark):
    rng = random.Random(4)
    pieces = ["password=", "secret: token = abcdefghijklmnop", "AKIA", "API_KEY='", "é😀", " ", "\n", "Token", " : ", "passwd\"  = \"", "deadbeef", "example"]
    alphabets = ["0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", S.ALPHABET, "abcdefghijklmnopqrstuvwxyz", "0123456789"]

    def one():
        out = []
        for _ in range(rng.randint(1, 10)):
            if rng.random() < 0.5:
                out.append(rng.choice(pieces))
            else:
                a = rng.choice(alphabets)
                out.append("".join(rng.choice(a) for _ in range(rng.randint(4, 45))))
        return "".join(out)

    rows = [(k, one()) for k in range(150)] + [(900, "550e8400-e29b-41d4-a716-446655440000 " * 2), (901, "a1b2" * 12)]
    check(spark.createDataFrame(rows, "doc_id long, text string"))


def test_letters_are_spans(spark):
    df = spark.createDataFrame([(1, "letter qxzvkjwpbfgmdhyrqnwx .")], "doc_id long, text string")
    r = S.secrets(df).first()
    assert (r["spans"], r["letters"], r["n_letters"]) == ("letters:7:27", "letters:7:27", 1)
    check(df)


def test_many_hits_in_one_text(spark):
    """Hits around the borders of blocks, and as many as 20,000 in one text."""
    rng = random.Random(2)

    def runs(n):
        return " ".join("".join(rng.choices("0123456789abcdef", k=rng.randint(15, 24))) for _ in range(n))

    check(spark.createDataFrame([(n, runs(n)) for n in (1, 127, 128, 129, 256, 257)], "doc_id long, text string"))
    text = runs(20_000)
    r = S.secrets(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    b = base(text)
    assert r["base_sha256"] == hashlib.sha256(told(b).encode()).hexdigest() and r["n_hex"] == len(b)


def test_random_strings_of_every_class_are_found(spark):
    rng = random.Random(9)
    lower, upper = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    classes = [lower + "0123456789", upper + "234567", lower + upper + "0123456789", lower + upper + "0123456789_-", "0123456789ABCDEF", lower, upper, lower + upper]
    kinds = [(k, n) for k in range(len(classes)) for n in (20, 24, 32, 40)]
    rows = [(k * 100 + n, "x " + "".join(rng.choices(classes[k], k=n)) + " y") for k, n in kinds for _ in range(150)]
    found = {}
    for r in S.secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        found[r["doc_id"]] = found.get(r["doc_id"], 0) + (r["n_assign"] + r["n_access"] + r["n_hex"] + r["n_entropy"] + r["n_letters"] > 0)
    assert len(found) == len(kinds) and min(found.values()) >= 0.93 * 150, found


def test_words_are_no_secrets(spark):
    words = ["internationalization", "Donaudampfschifffahrtsgesellschaft", "getElementsByClassName", "anticonstitutionnellement", "internationalization2020", "someCamelCaseIdentifierName2", "a-longer-title-v2-and-more-of-it",
             "some-article-title-with-words-2020", "/2020/03/12/some-article-title-of-the-day", "path/to/some/longer_file_name_here", "a-" * 30000 + "b"]
    out = S.secrets(spark.createDataFrame(list(enumerate(words)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [(r["n_entropy"], r["n_letters"]) for r in out] == [(0, 0)] * len(words), out


def test_edge_rows(spark):
    check(edge.table(spark))
    assert len(S.secrets(edge.table(spark)).collect()) == len(edge.ROWS)
    assert S.secrets(edge.empty(spark)).count() == 0
    assert "Python" not in S.secrets(edge.table(spark))._jdf.queryExecution().executedPlan().toString()
