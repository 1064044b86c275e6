"""Text features as native regex / string expressions.

Python's ``str`` methods and ``re`` classes are Unicode-aware; Java patterns here use
explicit Unicode classes (``\\p{L}``, ``\\p{Lu}``, ``\\p{Nd}``) or ``(?U)`` so that accented
letters count as letters, as they do in Python.  Whole texts are processed.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spark ML's default English stop-word list (StopWordsRemover, "english").
STOP_WORDS_EN = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her "
    "hers herself it its itself they them their theirs themselves what which who whom this that these "
    "those am is are was were be been being have has had having do does did doing a an the and but if "
    "or because as until while of at by for with about against between into through during before after "
    "above below to from up down in out on off over under again further then once here there when where "
    "why how all any both each few more most other some such no nor not only own same so than too very s "
    "t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd "
    "they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't "
    "weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't "
    "couldn't cannot could here's how's let's ought that's there's what's when's where's who's why's would"
).split()

# Negations kept when stop words are removed for sentiment work.
NEGATIONS_KEEP = ["not", "no", "nor", "never", "none", "cannot"]

# URL, currency, phone-like and special-character patterns of the message features.
URL_TLDS = "com|net|org|info|ng|uk|co|ly|link|click|xyz"
URL_PATTERN = rf"(?iU)(https?://\S+|www\.\S+|\b\w+\.(?:{URL_TLDS})\b)"
CURRENCY_PATTERN = "[£$€₦]"
PHONE_PATTERN = r"^\p{Nd}{4,}$"
CAPS_PATTERN = r"^[A-Z]{2,}$"
WORD_PATTERN = r"([\p{L}\p{N}_]+)"
URL_STRIP_PATTERN = r"(https?://\S+|www\.\S+)"
SPECIAL_PATTERN = r"(?U)[^a-zA-Z0-9\s]"

# Weak-supervision keyword lists (lower-cased substrings), in priority order
# Fraud > Phishing > Promotion.
FRAUD_TERMS = [
    "won", "winner", "win a", "you win", "prize", "award", "awarded", "lottery", "lotto", "jackpot",
    "congratulations", "congrats", "claim your", "cash prize", "guaranteed", "reward", "£1000", "£500",
    "$1000", "1 million", "million", "investment", "bitcoin", "crypto", "inheritance", "beneficiary",
    "selected to receive", "you have been selected", "claim now", "100% free", "free entry", "draw",
]
PHISH_TERMS = [
    "verify", "verification", "confirm your", "your account", "account is", "suspend", "suspended",
    "log in", "login", "password", "otp", "one-time", "one time code", "pin code", "your pin", "kyc",
    "validate", "update your", "unusual activity", "locked", "unauthorized", "unauthorised",
    "secure your", "card blocked", "card has been", "bank", "debit", "credit alert", "click the link",
    "click here to", "dear customer", "dear subscriber", "reactivate", "restore your",
]
PROMO_TERMS = [
    "offer", "sale", "discount", "% off", "voucher", "coupon", "free delivery", "shop now", "buy now",
    "subscribe", "unsubscribe", "reply stop", "txt stop", "text stop", "ringtone", "new arrival",
    "limited time", "sign up", "deal", "save up to", "promo", "upgrade", "latest", "exclusive", "tones",
    "to opt out",
]
LABEL_URL_PATTERN = rf"(?iU)(https?://|www\.|\b\w+\.({URL_TLDS})\b)"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def count_matches(x, pattern: str) -> Column:
    return F.regexp_count(_c(x), F.lit(pattern)).cast("long")


def count_words_like(x, pattern: str) -> Column:
    """Whole words (maximal runs of letters, digits, underscore) that match ``pattern``."""
    words = F.regexp_extract_all(_c(x), F.lit(WORD_PATTERN), F.lit(1))
    return F.size(F.filter(words, lambda w: F.rlike(w, F.lit(pattern)))).cast("long")


def message_features(text) -> dict[str, Column]:
    """The twelve message features."""
    t = F.coalesce(_c(text), F.lit(""))
    n = F.greatest(F.length(t), F.lit(1))
    digits = count_matches(t, r"\p{Nd}")
    upper = count_matches(t, r"\p{Lu}")
    letters = count_matches(t, r"\p{L}")
    return {
        "msg_length": F.length(t).cast("long"),
        "char_count": F.length(F.replace(t, F.lit(" "), F.lit(""))).cast("long"),
        "word_count": count_matches(t, r"\S+"),
        "n_urls": count_matches(t, URL_PATTERN),
        "n_digits": digits,
        "digit_ratio": digits / n,
        "n_currency": count_matches(t, CURRENCY_PATTERN),
        "n_uppercase": upper,
        "uppercase_ratio": upper / F.greatest(letters, F.lit(1)),
        "n_exclaim": count_matches(t, "!"),
        "n_special": count_matches(t, SPECIAL_PATTERN),
        "has_phone": (count_words_like(t, PHONE_PATTERN) > 0).cast("int"),
    }


def review_features(text) -> dict[str, Column]:
    """T2 + T3: words, chars, sentences (runs of .!? , at least 1), ALL-CAPS words,
    exclamation and question marks, mean word length."""
    t = F.coalesce(_c(text), F.lit(""))
    words = count_matches(t, r"\S+")
    word_chars = F.length(F.regexp_replace(t, r"\s+", ""))
    return {
        "word_count": words,
        "char_count": F.length(t).cast("long"),
        "sentence_count": F.greatest(count_matches(t, r"[.!?]+"), F.lit(1)),
        "caps_words": count_words_like(t, CAPS_PATTERN),
        "n_exclaim": count_matches(t, "!"),
        "n_question": count_matches(t, r"\?"),
        "avg_word_len": F.try_divide(word_chars, words),
        "upper_ratio": F.round(count_matches(t, r"\p{Lu}") / F.greatest(F.length(t), F.lit(1)), 3),
    }


def clean_tokens_raw(text, strip_redactions: bool = True, url_pattern: str = URL_STRIP_PATTERN) -> Column:
    """T4 first half: lower -> strip URLs -> strip HTML tags -> strip ``xx..``
    redactions -> non a-z to space -> whitespace tokens (stop words still in)."""
    t = F.lower(F.coalesce(_c(text), F.lit("")))
    t = F.regexp_replace(t, url_pattern, " ")
    t = F.regexp_replace(t, r"<[^>]+>", " ")
    if strip_redactions:
        t = F.regexp_replace(t, r"x{2,}", " ")
    t = F.regexp_replace(t, r"[^a-z\s]", " ")
    return F.split(F.trim(t), r"\s+")


def clean_text(text, stop_words: Sequence[str] = STOP_WORDS_EN, min_len: int = 3,
               strip_redactions: bool = True) -> Column:
    """T4: lower -> strip URLs -> strip HTML tags -> strip ``xx..`` redactions -> non
    a-z to space -> tokens of at least ``min_len`` chars not in ``stop_words``.
    Column form (usable on streams); DataFrame pipelines use ``clean_tokens`` which
    removes stop words with the JVM ``StopWordsRemover``."""
    toks = clean_tokens_raw(text, strip_redactions)
    sw = F.array(*[F.lit(w) for w in stop_words])
    return F.filter(toks, lambda w: (F.length(w) >= min_len) & ~F.array_contains(sw, w))


def clean_tokens(df, text: str, out: str, stop_words: Sequence[str] = STOP_WORDS_EN, min_len: int = 3,
                 url_pattern: str = URL_STRIP_PATTERN):
    """T4 on a DataFrame: raw cleaned tokens, stop words removed by ``StopWordsRemover``
    (hash lookups), then tokens shorter than ``min_len`` dropped."""
    from pyspark.ml.feature import StopWordsRemover
    d = df.withColumn("_ct_raw", clean_tokens_raw(text, url_pattern=url_pattern))
    d = StopWordsRemover(inputCol="_ct_raw", outputCol="_ct_sw", stopWords=list(stop_words)).transform(d)
    return d.withColumn(out, F.filter("_ct_sw", lambda w: F.length(w) >= min_len)).drop("_ct_raw", "_ct_sw")


def sentiment_stop_words() -> list[str]:
    """T5: stop words minus negations."""
    keep = set(NEGATIONS_KEEP)
    return [w for w in STOP_WORDS_EN if w not in keep]


def contains_any(text, terms: Sequence[str]) -> Column:
    t = _c(text)
    out = F.lit(False)
    for w in terms:
        out = out | F.contains(t, F.lit(w))
    return out


def weak_label(text, is_ham, seed, fraud: Sequence[str] = FRAUD_TERMS, phish: Sequence[str] = PHISH_TERMS,
               promo: Sequence[str] = PROMO_TERMS) -> Column:
    """Ham -> Normal; else Fraud > Phishing (or URL and seed) > Promotion >
    seed -> Phishing > Spam, by lower-cased substring lists."""
    t = F.lower(F.coalesce(_c(text), F.lit("")))
    has_url = F.regexp_like(t, F.lit(LABEL_URL_PATTERN))
    sd = F.coalesce(_c(seed), F.lit(0)) == 1
    return (F.when(_c(is_ham), "Normal")
             .when(contains_any(t, fraud), "Fraud")
             .when(contains_any(t, phish) | (has_url & sd), "Phishing")
             .when(contains_any(t, promo), "Promotion")
             .when(sd, "Phishing")
             .otherwise("Spam"))


def word_tokens(text, lower: bool = True) -> Column:
    """``(?u)\\b\\w\\w+\\b`` tokens = maximal runs of >= 2 word characters."""
    t = F.coalesce(_c(text), F.lit(""))
    if lower:
        t = F.lower(t)
    return F.regexp_extract_all(t, F.lit(r"([\p{L}\p{N}_]{2,})"), 1)


def ngrams(tokens, n: int) -> Column:
    """Contiguous word n-grams joined by one space (empty when fewer than n tokens)."""
    tk = _c(tokens)
    if n == 1:
        return tk
    grams = F.transform(F.sequence(F.lit(1), F.size(tk) - n + 1), lambda i: F.array_join(F.slice(tk, i, n), " "))
    return F.when(F.size(tk) >= n, grams).otherwise(F.array().cast("array<string>"))


def char_wb_ngrams(tokens, lo: int = 3, hi: int = 4) -> Column:
    """Character n-grams inside word boundaries (each token padded with spaces;
    a padded token shorter than n yields itself once)."""
    padded = F.transform(_c(tokens), lambda w: F.concat(F.lit(" "), w, F.lit(" ")))  # once a token, not once a gram
    parts = []
    for n in range(lo, hi + 1):
        parts.append(F.flatten(F.transform(padded, lambda p: F.transform(
            F.sequence(F.lit(1), F.greatest(F.length(p) - n + 1, F.lit(1))), lambda i: F.substring(p, i, n)))))
    out = parts[0]
    for p in parts[1:]:
        out = F.concat(out, p)
    return out
