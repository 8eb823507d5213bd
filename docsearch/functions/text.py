"""Text rules as Column functions.

Everything here is a built-in Spark expression, evaluated inside the JVM.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Sequence
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from docsearch import fixed_values as V

# Unicode white space plus the four separators that Python also counts.
_SPACE = r"\s\x1c-\x1f"
_KEPT = r"\p{L}\p{N}_$.,/\-"
_NON_ASCII = r"[^\x00-\x7f]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it several times in ``body``.

    A plain reference would be copied into each use, and evaluated once per
    element where the use is inside a lambda.
    """
    return F.transform(F.array(value), body)[0]


def strip(c: Column | str) -> Column:
    """Remove white space of any kind at both ends."""
    return F.regexp_replace(
        _col(c), rf"(?U)^[{_SPACE}]+|[{_SPACE}]+$", ""
    )


def is_blank(c: Column | str) -> Column:
    """True for null, empty and white-space-only text."""
    c = _col(c)
    return c.isNull() | ~c.rlike(rf"(?U)[^{_SPACE}]")


def collapse_spaces(c: Column | str) -> Column:
    """One space for each run of white space. A single space stays, so it is not matched."""
    runs = rf"(?U)[{_SPACE}&&[^ ]][{_SPACE}]*| [{_SPACE}]+"
    return F.trim(F.regexp_replace(_col(c), runs, " "))


# --- cleaning ---------------------------------------------------------------


def mask_patterns(c: Column | str) -> Column:
    """Put placeholders for amounts, dates, invoice and order references."""
    masked = _col(c)
    for pattern, token in (
        (V.AMOUNT_PATTERN, V.AMOUNT_TOKEN),
        (V.DATE_PATTERN, V.DATE_TOKEN),
        (V.INVOICE_PATTERN, V.INVOICE_TOKEN),
        (V.PO_PATTERN, V.PO_TOKEN),
    ):
        masked = F.regexp_replace(masked, pattern, token)
    return masked


def clean_text(c: Column | str) -> Column:
    """Normalise text for indexing: lower case, placeholders, plain characters."""
    masked = mask_patterns(collapse_spaces(F.lower(_col(c))))
    # Runs of spaces and characters that go, but for a single space, which stays as it is.
    plain = F.regexp_replace(masked, rf"[^{_KEPT} ][^{_KEPT}]*| [^{_KEPT}]+", " ")
    return F.coalesce(F.trim(plain), F.lit(""))


def survives_cleaning(c: Column | str) -> Column:
    """True when ``clean_text`` leaves something of the text."""
    return F.coalesce(_col(c).rlike(f"[{_KEPT}]"), F.lit(False))


# --- extraction -------------------------------------------------------------


def extract_key_terms(c: Column | str) -> Column:
    """Finance words that occur in the text, sorted."""
    low = F.lower(_col(c))
    found = [F.when(low.contains(term), F.lit(term)) for term in V.FINANCE_TERMS]
    return F.array_sort(F.array_compact(F.array(*found)))


def extract_amounts(c: Column | str) -> Column:
    return F.regexp_extract_all(_col(c), F.lit(V.AMOUNT_PATTERN), F.lit(0))


def extract_dates(c: Column | str) -> Column:
    return F.regexp_extract_all(_col(c), F.lit(V.DATE_PATTERN), F.lit(0))


def extract_invoice_numbers(c: Column | str) -> Column:
    found = F.regexp_extract_all(_col(c), F.lit(V.INVOICE_PATTERN), F.lit(1))
    return F.filter(found, lambda x: x != "")


def extract_po_numbers(c: Column | str) -> Column:
    found = F.regexp_extract_all(_col(c), F.lit(V.PO_PATTERN), F.lit(1))
    return F.filter(found, lambda x: x != "")


# --- tokens -----------------------------------------------------------------


@lru_cache(maxsize=1)
def _ascii_forms() -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """Accent folding by rule: letters and digits with an ASCII base form.

    Returns the two sides of a one-to-one translation and the few characters
    (ligatures, fractions) whose ASCII form is longer than one letter.
    """
    single_from, single_to, longer = [], [], []
    for point in range(0x80, 0x20000):
        ch = chr(point)
        if not ch.isalnum():
            continue
        ascii_form = unicodedata.normalize("NFKD", ch).encode("ascii", "ignore").decode()
        if len(ascii_form) == 1:
            single_from.append(ch)
            single_to.append(ascii_form)
        elif ascii_form:
            longer.append((ch, ascii_form))
    return "".join(single_from), "".join(single_to), tuple(longer)


def _ranges(chars: Sequence[str]) -> str:
    """Regular-expression class of the characters, as few ranges as possible."""
    out = []
    for point in sorted(map(ord, chars)):
        if out and point == out[-1][1] + 1:
            out[-1][1] = point
        else:
            out.append([point, point])
    return "[" + "".join(rf"\x{{{lo:x}}}-\x{{{hi:x}}}" for lo, hi in out) + "]"


def fold_accents(c: Column | str) -> Column:
    """ASCII form of the text; characters without one are dropped.

    Pure ASCII text passes through, and the longer forms are only looked for in
    text that still holds other characters after the one-to-one step.
    """
    single_from, single_to, longer = _ascii_forms()
    forms = F.split(F.lit(" ".join(ch + form for ch, form in longer)), " ")
    has_longer = _ranges([ch for ch, _ in longer])

    def spell_out(text: Column) -> Column:
        present = F.filter(forms, lambda f: F.contains(text, F.substring(f, 1, 1)))
        spelled = F.when(text.rlike(has_longer), F.aggregate(
            present, text,
            lambda acc, f: F.replace(acc, F.substring(f, 1, 1), F.substr(f, F.lit(2))),
        )).otherwise(text)
        return F.when(
            text.rlike(_NON_ASCII), F.regexp_replace(spelled, _NON_ASCII, "")
        ).otherwise(text)

    return let(_col(c), lambda text: F.when(
        text.rlike(_NON_ASCII), let(F.translate(text, single_from, single_to), spell_out)
    ).otherwise(text))


def tokenise(c: Column | str, stop_words: Sequence[str] = ()) -> Column:
    """Lower-case ASCII words that start with a letter, without stop words."""
    words = F.regexp_extract_all(
        fold_accents(F.lower(_col(c))), F.lit(V.TOKEN_PATTERN), F.lit(0)
    )
    return without(words, stop_words)


def tokenise_fallback(c: Column | str) -> Column:
    """Words of two or more characters, nothing removed."""
    return F.regexp_extract_all(
        F.lower(_col(c)), F.lit(V.FALLBACK_TOKEN_PATTERN), F.lit(0)
    )


def without(words: Column, stop_words: Sequence[str]) -> Column:
    if not stop_words:
        return words
    return F.filter(words, lambda w: ~w.isin(*stop_words))


def ngrams(tokens: Column | str, ngram_range: tuple[int, int] = V.NGRAM_RANGE) -> Column:
    """Runs of ``low`` to ``high`` neighbouring tokens, joined by a space."""
    low, high = ngram_range

    def all_runs(t: Column) -> Column:
        size, runs, parts = F.size(t), t, []
        for n in range(1, high + 1):
            if n > 1:
                longer = F.zip_with(
                    F.slice(runs, F.lit(1), size - (n - 1)), F.slice(t, F.lit(n), size),
                    lambda run, token: F.concat(run, F.lit(" "), token),
                )
                runs = F.when(size >= n, longer).otherwise(F.array().cast("array<string>"))
            if n >= low:
                parts.append(runs)
        return parts[0] if len(parts) == 1 else F.concat(*parts)

    return let(_col(tokens), all_runs)


def term_counts(terms: Column | str) -> Column:
    """Distinct terms of one row with their counts: ``array<struct<term, tf>>``.

    Sorts the row's terms and measures the runs, so counting needs no shuffle.
    """
    def runs(ordered: Column) -> Column:
        n = F.size(ordered)
        starts = F.filter(
            F.sequence(F.lit(0), n - 1),
            lambda i: (i == 0) | (ordered[i] != F.get(ordered, i - 1)),
        )
        return F.when(n > 0, let(starts, lambda s: F.transform(s, lambda start, j: F.struct(
            ordered[start].alias("term"),
            (F.coalesce(F.get(s, j + 1), n) - start).cast("bigint").alias("tf"),
        ))))

    return let(F.sort_array(_col(terms)), runs)


# --- query terms, matches, snippets ------------------------------------------


def query_terms(c: Column | str) -> Column:
    """Words of the raw query in lower case; repeats stay."""
    return F.filter(
        F.split(F.lower(_col(c)), rf"(?U)[{_SPACE}]+"), lambda t: t != ""
    )


def matched_terms(content: Column | str, terms: Column | str) -> Column:
    """Query terms found in the content, and finance words of the content that
    hold a query term. Distinct and sorted."""
    terms = _col(terms)

    def body(low: Column) -> Column:
        direct = F.filter(terms, lambda t: F.contains(low, t))
        finance = F.filter(
            F.array(*[F.lit(t) for t in V.FINANCE_TERMS]),
            lambda word: F.exists(terms, lambda t: F.contains(word, t)) & F.contains(low, word),
        )
        return F.array_sort(F.array_union(direct, finance))

    return let(F.lower(_col(content)), body)


def _best_offset(low: Column, length: Column, terms: Column, max_length: int) -> Column:
    """Offset of the first window that holds the most terms.

    Terms that occur nowhere in the text are left out first. The text is cut
    once into step-sized blocks, and a window is joined from its blocks, so the
    work grows linearly with the text. A stretch of ten windows holds at least
    the terms of each of them; only stretches that can beat the best window of
    the fullest stretch are looked at window by window.
    """
    step, group = V.SNIPPET_STEP, 10
    per_window = -(-max_length // step)

    def scan(blocks: Column, present: Column) -> Column:
        last = F.floor((length - max_length) / step).cast("int")

        def held(first_block: Column, n_blocks: int, n_chars: int) -> Column:
            text = F.substring(
                F.array_join(F.slice(blocks, first_block + 1, F.lit(n_blocks)), ""), 1, n_chars
            )
            return let(text, lambda w: F.size(F.filter(present, lambda t: F.contains(w, t))))

        def window(i: Column) -> Column:
            return F.struct(held(i, per_window, max_length).alias("found"), (-i).alias("at"))

        def stretch(k: Column) -> Column:
            n_blocks = per_window + group - 1
            return F.struct(
                held(k * group, n_blocks, n_blocks * step).alias("found"), (-k).alias("at")
            )

        def best_window(one: Column) -> Column:
            first = -one["at"] * group
            return F.array_max(F.transform(
                F.sequence(first, F.least(first + (group - 1), last)), window
            ))

        def search(stretches: Column) -> Column:
            def beyond(fullest: Column, best: Column) -> Column:
                rivals = F.filter(stretches, lambda one: (one["found"] > best["found"]) & (
                    one["at"] != fullest["at"]
                ) | ((one["found"] == best["found"]) & (one["at"] > fullest["at"])))
                return F.array_max(F.concat(F.array(best), F.transform(rivals, best_window)))

            return let(F.array_max(stretches), lambda fullest: let(
                best_window(fullest), lambda best: beyond(fullest, best)
            ))

        stretches = F.transform(
            F.sequence(F.lit(0), F.floor(last / group).cast("int")), stretch
        )
        return let(let(stretches, search), lambda best: F.when(
            best["found"] > 0, -best["at"] * step
        ).otherwise(0))

    def with_present(present: Column) -> Column:
        blocks = F.regexp_extract_all(low, F.lit(f"(?s).{{1,{step}}}"), F.lit(0))
        return F.when(
            F.size(present) > 0, let(blocks, lambda cut: scan(cut, present))
        ).otherwise(0)

    present = F.filter(terms, lambda t: F.contains(low, t))
    return F.when(length > max_length, let(present, with_present)).otherwise(0)


def context_snippet(
    content: Column | str, terms: Column | str, max_length: int = V.SNIPPET_LENGTH
) -> Column:
    """Part of the content that holds the most query terms, cut at words."""
    content, terms = _col(content), _col(terms)
    length = F.length(content)

    def at(best: Column) -> Column:
        def lead(raw: Column) -> Column:
            gap = F.instr(raw, " ")
            return F.when(
                (best > 0) & (gap > 1), F.substr(raw, gap + 1)
            ).otherwise(raw)

        def tail(cut: Column) -> Column:
            last_gap = F.length(cut) - F.instr(F.reverse(cut), " ")
            return F.when(
                (F.length(cut) == max_length)
                & (F.substr(content, best + (max_length + 1), F.lit(1)) != " ")
                & (F.instr(cut, " ") > 0)
                & (last_gap > max_length * V.SNIPPET_TAIL_SHARE),
                F.substr(cut, F.lit(1), last_gap),
            ).otherwise(cut)

        def dots(cut: Column) -> Column:
            front = F.when(best > 0, F.concat(F.lit("..."), cut)).otherwise(cut)
            return let(front, lambda s: strip(
                F.when(best + F.length(s) < length, F.concat(s, F.lit("..."))).otherwise(s)
            ))

        raw = F.substr(content, best + 1, F.lit(max_length))
        return let(let(let(raw, lead), tail), dots)

    found = let(
        let(F.lower(content), lambda low: _best_offset(low, length, terms, max_length)), at
    )
    return (
        F.when(content.isNull() | (content == ""), F.lit(""))
        .when(terms.isNull() | (F.size(terms) == 0), F.substring(content, 1, max_length))
        .otherwise(found)
    )


# --- encoder input ----------------------------------------------------------


def key_sections(c: Column | str) -> Column:
    """Sentences that hold a section keyword; else the start of the text."""
    c = _col(c)

    def is_key(sentence: Column) -> Column:
        low = F.lower(sentence)
        hit = low.contains(V.SECTION_KEYWORDS[0])
        for keyword in V.SECTION_KEYWORDS[1:]:
            hit = hit | low.contains(keyword)
        return hit

    kept = F.transform(F.filter(F.split(c, r"\."), is_key), strip)

    def joined(sentences: Column) -> Column:
        text = F.array_join(sentences, ". ")
        return F.when(F.size(sentences) > 0, let(text, lambda t: F.when(
            F.length(t) > V.KEY_SECTION_LENGTH,
            F.concat(F.substring(t, 1, V.KEY_SECTION_LENGTH), F.lit("...")),
        ).otherwise(t))).otherwise(F.substring(c, 1, V.KEY_SECTION_LENGTH))

    return let(kept, joined)


def embedding_text(
    content: Column | str, doc_type: Column | str, entity_id: Column | str
) -> Column:
    """Text given to the encoder for a document."""
    cleaned = clean_text(content)
    body = F.when(
        F.length(cleaned) > V.EMBEDDING_TEXT_LENGTH,
        F.substring(key_sections(cleaned), 1, V.EMBEDDING_TEXT_LENGTH),
    ).otherwise(cleaned)
    return F.concat(
        F.lit("["), F.upper(_col(doc_type)), F.lit("] [ENTITY: "), _col(entity_id),
        F.lit("] "), body,
    )


def query_embedding_text(c: Column | str) -> Column:
    """Text given to the encoder for a query."""
    return F.concat(F.lit(V.QUERY_PREFIX + " "), clean_text(c))


# --- other scalars ------------------------------------------------------------


def entity_key(c: Column | str) -> Column:
    """Key of a company name."""
    return F.replace(
        F.replace(F.lower(_col(c)), F.lit(" "), F.lit("_")), F.lit("."), F.lit("")
    )


def is_financial_document(doc_type: Column | str) -> Column:
    return _col(doc_type).isin(*V.FINANCIAL_DOC_TYPES)


def parse_doc_type(c: Column | str) -> Column:
    """The type itself when it is one of the known types, else null."""
    c = _col(c)
    return F.when(c.isin(*V.DOC_TYPES), c)


def parse_iso_date(c: Column | str) -> Column:
    """Naive ISO date or date-time; null when malformed or with an offset."""
    c = _col(c)
    naive = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}([.,]\d{1,6})?)?)?$"
    return F.when(
        c.rlike(naive), F.replace(c, F.lit(","), F.lit(".")).try_cast("timestamp_ntz")
    )


def metadata_get(metadata: Column | str, key: str, type_name: str, default=None) -> Column:
    """Value of one metadata key, or the default."""
    value = F.try_variant_get(_col(metadata), f"$.{key}", type_name)
    return value if default is None else F.coalesce(value, F.lit(default).cast(type_name))
