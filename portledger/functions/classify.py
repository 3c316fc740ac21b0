"""Product-type and country rules, as Column expressions.

Keywords are parameters; the defaults are fixed values of the data contract.
"""

from functools import reduce
from operator import or_

from pyspark.sql import functions as F

from portledger.functions.text import as_column, safe_str

# Product-type keywords.
FROZEN_KEYWORDS = ("냉동", "생녹용")
DRIED_KEYWORD = "건조"
DRIED_SYLLABLE = "건"
HEALTH_KEYWORD = "건강"
FRESH_SYLLABLE = "생"
FROZEN_WORD = "냉동"
PLAIN_PRODUCT = "녹용"

# Bucket name -> text in the English name, text in the Korean name; first match wins.
COUNTRY_BUCKETS = {
    "NZ": ("New Zealand", "뉴질랜드"),
    "Russia": ("Russia", "러시아"),
    "China": ("China", "중국"),
}
OTHER_BUCKET = "Other"
COUNTRIES = [*COUNTRY_BUCKETS, OTHER_BUCKET]

TYPES = ["frozen", "dried", "ambiguous"]


def _has_any(text, words):
    return reduce(or_, [text.contains(w) for w in words])


def weekly_type_flags(type_ko, frozen_keywords=FROZEN_KEYWORDS):
    """Weekly rule: the dried syllable counts anywhere in the text unless the text is frozen."""
    text = safe_str(type_ko)
    frozen, dried = _has_any(text, frozen_keywords), text.contains(DRIED_KEYWORD)
    loose = text.contains(DRIED_SYLLABLE) & ~text.contains(HEALTH_KEYWORD)
    only_frozen, only_dried = frozen & ~dried, ~frozen & (dried | loose)
    return {
        "type_frozen": only_frozen,
        "type_dried": only_dried,
        "type_ambiguous": ~(only_frozen | only_dried),
    }


def historical_type_flags(type_ko, type_en, frozen_keywords=FROZEN_KEYWORDS):
    """Historical rule: the dried syllable counts at the start only; blank Korean uses English.

    A text that is frozen and dried at once, or neither, is ambiguous.
    """
    ko, en = safe_str(type_ko), F.lower(safe_str(type_en))
    blank = ko == ""
    frozen = F.when(blank, en.contains("frozen")).otherwise(_has_any(ko, frozen_keywords))
    leading = ko.startswith(DRIED_SYLLABLE) & ~ko.contains(HEALTH_KEYWORD)
    dried = F.when(blank, en.contains("dried")).otherwise(ko.contains(DRIED_KEYWORD) | leading)
    return {
        "type_frozen": frozen & ~dried,
        "type_dried": dried & ~frozen,
        "type_ambiguous": frozen == dried,
    }


def is_frozen_product(product_ko, frozen_keywords=FROZEN_KEYWORDS):
    return _has_any(safe_str(product_ko), frozen_keywords)


def is_dried_product(product_ko):
    """Product-name rule: a plain, neither frozen nor fresh product counts as dried."""
    text = safe_str(product_ko)
    plain = text.contains(PLAIN_PRODUCT) & ~text.contains(FROZEN_WORD) & ~text.contains(FRESH_SYLLABLE)
    return text.contains(DRIED_KEYWORD) | plain


def type_label(frozen="type_frozen", dried="type_dried"):
    """One label per record; frozen goes before dried, missing flags mean ambiguous."""
    return F.when(as_column(frozen), "frozen").when(as_column(dried), "dried").otherwise("ambiguous")


def country_bucket(en="country_export_en", ko="country_export_ko", buckets=None, other=OTHER_BUCKET):
    """Report bucket of an export country, by English or Korean text, case-sensitive."""
    en, ko = F.coalesce(as_column(en), F.lit("")), F.coalesce(as_column(ko), F.lit(""))
    chain = F
    for name, (en_text, ko_text) in (buckets or COUNTRY_BUCKETS).items():
        chain = chain.when(en.contains(en_text) | ko.contains(ko_text), name)
    return chain.otherwise(other)
