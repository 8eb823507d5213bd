import random

import pytest
from pyspark.sql import functions as F

from docsearch.functions import text as X


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "t string").select(column).first()[0]


@pytest.mark.parametrize("raw, cleaned", [
    ("invoice", "INVOICE_TOKEN"),
    ("invoice software licensing", "INVOICE_TOKEN licensing"),
    ("Invoice #INV-2024-001 from ACME Corp. Total amount: $1,250.00.",
     "INVOICE_TOKEN-AMOUNT_TOKENAMOUNT_TOKEN-AMOUNT_TOKEN from acme corp. "
     "total amount AMOUNT_TOKEN."),
    ("IT support and corporate purpose on 01/15/2024",
     "it supPO_TOKEN and corPO_TOKEN purPO_TOKEN on "
     "AMOUNT_TOKEN/AMOUNT_TOKEN/AMOUNT_TOKENAMOUNT_TOKEN"),
    ("!!!", ""), ("", ""), (None, ""), ("  a  \x1c b\n", "a b"),
])
def test_clean_text(spark, raw, cleaned):
    assert one(spark, raw, X.clean_text("t")) == cleaned
    assert one(spark, raw, X.survives_cleaning("t")) == (cleaned != "")


def test_clean_text_leaves_single_spaces_alone_and_is_as_with_plain_patterns(spark):
    """Each single space was matched and put in again, in two passes."""
    dice = random.Random(7)
    signs = "ab9é$.,/-_  \t\n\x1c\x1f\x85\xa0\u2028\u3000!?#€½"
    texts = ["".join(dice.choice(signs) for _ in range(dice.randrange(30))) for _ in range(400)]
    spaces = F.trim(F.regexp_replace(F.lower("t"), rf"(?U)[{X._SPACE}]+", " "))
    gaps = F.regexp_replace(X.mask_patterns(spaces), rf"[^{X._KEPT} ]", " ")
    plain = F.trim(F.regexp_replace(gaps, " +", " "))
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(
        X.collapse_spaces(F.lower("t")), spaces, X.clean_text("t"), plain).collect()
    assert all(r[0] == r[1] and r[2] == r[3] for r in rows)
    assert ",  +," not in str(spark.sql("select '' t").select(
        X.clean_text("t"))._jdf.queryExecution().analyzed())


def test_extraction_reads_raw_text(spark):
    raw = "Invoice # A77 and PO 9, due 01/02/2024, $1,234.50"
    assert one(spark, raw, X.extract_invoice_numbers("t")) == ["A77"]
    assert one(spark, raw, X.extract_po_numbers("t")) == ["9"]
    assert one(spark, raw, X.extract_dates("t")) == ["01/02/2024"]
    assert "$1,234.50" in one(spark, raw, X.extract_amounts("t"))
    assert one(spark, raw, X.extract_key_terms("t")) == ["due", "invoice"]


def test_tokens_fold_accents_and_drop_stop_words(spark):
    raw = "Éöñ ﬁne ½ x_y the 9a b2 straße"
    assert one(spark, raw, X.tokenise("t", ("the",))) == ["eon", "fine", "b2", "strae"]


def test_ngrams_and_counts(spark):
    tokens = F.split("t", " ")
    assert one(spark, "a b a b", X.ngrams(tokens)) == ["a", "b", "a", "b", "a b", "b a", "a b"]
    assert one(spark, "a", X.ngrams(tokens)) == ["a"]
    assert one(spark, "a b c", X.ngrams(tokens, (2, 3))) == ["a b", "b c", "a b c"]
    counts = one(spark, "a b a b", X.term_counts(X.ngrams(tokens)))
    assert {r["term"]: r["tf"] for r in counts} == {"a": 2, "b": 2, "a b": 2, "b a": 1}
    assert one(spark, "a", X.term_counts(F.array().cast("array<string>"))) is None


def snippets(spark, texts, terms, length):
    return [r["s"] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(
        X.context_snippet("t", F.array(*map(F.lit, terms)), length).alias("s")).collect()]


@pytest.mark.parametrize("text, terms, length, snippet", [
    ("short text", ["text"], 50, "short text"),
    ("", ["a"], 50, ""),
    # Nothing found: the beginning, cut at a word.
    ("aaaa bbbb cccc dddd eeee ffff", ["zz"], 21, "aaaa bbbb cccc dddd..."),
    # The last window that can hold the term; the word it begins in is left out.
    ("x" * 20 + " filler filler the needle", ["needle"], 25, None),
])
def test_snippet_cases(spark, text, terms, length, snippet):
    found = snippets(spark, [text], terms, length)[0]
    if snippet is None:
        assert "needle" in found and found.startswith("...")
    else:
        assert found == snippet


@pytest.mark.parametrize("length", [50, 200])
def test_snippet_properties(spark, length):
    """A snippet is a stretch of the text with ellipses where text is left out, and begins in
    the stated windows the one with the most terms, the earliest of equal ones."""
    rng = random.Random(5)
    vocabulary = ["ab", "Abc", "xyz", "longerword", "to", "q", "Zz."]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(n)).strip()
             for n in [1, 5, 30, 60, 61, 62, 100, 200, 400] * 6]
    terms = ["abc", "q", "zz", "nowhere"]
    for text, found in zip(texts, snippets(spark, texts, terms, length), strict=True):
        core = found.removeprefix("...").removesuffix("...")
        assert core in text and len(core) <= length
        if len(text) <= length:
            assert found == text
            continue
        hits = {s: sum(t in text[s:s + length].lower() for t in terms)
                for s in range(0, len(text) - length + 1, 20)}
        best = min(s for s in hits if hits[s] == max(hits.values()))
        at = [i for i in range(len(text)) if text.startswith(core, i)]
        assert any(best <= i <= best + len(max(vocabulary, key=len)) + 1 for i in at)
        assert found.startswith("...") == (best > 0)
        # Words stay whole; only the last may be cut.
        assert all(w in vocabulary for w in core.split()[:-1])


def test_iso_dates(spark):
    parse = F.date_format(X.parse_iso_date("t"), "yyyy-MM-dd HH:mm")
    assert one(spark, "2024-01-02", parse) == "2024-01-02 00:00"
    assert one(spark, "2024-01-02T03:04:05.123456", parse) == "2024-01-02 03:04"
    for bad in ("2024-01-02T03:04:05+00:00", "2024-13-01", "soon", None):
        assert one(spark, bad, parse) is None
