"""Vocabulary and rules as data: what the operators look for is a parameter, never code."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# --- Fixed values: they must be these for the results to be right. -----------------------------------------------

MOJIBAKE = ["�", "ï¿½", "Ã©", "Ã¡", "Ã­", "Ã³", "Ãº", "Ã±", "Ã¼", "â€™", "â€œ", "â€\u009D", "â€–", "â€—", "â€¦"]
BOILERPLATE = ["^(read more|advertisement)$"]
MARKERS = "the and of to in for with on from is are was were this that it as at by be have has had will can you we they he she a an".split()
CONTENT = "act announced change changes city climate country government hold local new people plan policy responsible team teams them".split()
BOUNDARIES = "ang ng mga sa para kay ni si at na ay dahil kung nang upang ito iyon".split()
INFORMAL = ["(?i)(?<!\\w)(lol|lmao|omg|hahaha+|hehe+)(?!\\w)", "(?i)(?<!\\w)(xd|wla|d2|aq)(?!\\w)"]
FUNCTION_WORDS = "ang ng mga sa at na ay si ni kay para kung dahil nang upang ito iyon isang ako ikaw siya sila nila niya din rin daw raw".split()
EDIT_CONTEXTS = "ang ng mga sa at na ay si ni kay para kung dahil nang upang".split()
SWAPS = {"nang": "ng", "ng": "nang"}
ENCLITICS = {"daw": "raw", "raw": "daw", "din": "rin", "rin": "din", "dito": "rito", "rito": "dito", "diyan": "riyan", "riyan": "diyan", "doon": "roon", "roon": "doon"}
ENCLITIC_EXCEPTIONS = ["din", "rin", "daw", "raw"]
EXCEPTION_ENDINGS = ["ri", "ra", "raw", "ray"]
PRONOUNS = {"nila": "sila", "niya": "siya", "sila": "nila", "siya": "niya"}
STATES = ["BASE", "COMPACT", "INCACT", "CONTACT", "IMPACT", "COMPOBJ", "INCOBJ", "CONTOBJ", "IMPOBJ", "RECCOMP"]
UNTARGETED_STATES = ["IMPACT", "IMPOBJ"]
MARKS = {"EMARK": "!", "PERIOD": ".", "QMARK": "?"}
HYPHEN_TAGS = ["$MERGE_HYPHEN", "$TRANSFORM_INSERT_HYPHEN", "$TRANSFORM_SPLIT_HYPHEN"]
SPACE_TAGS = ["$MERGE_SPACE", "$TRANSFORM_SPLIT_SPACE"]
TAGS = [
    *[(f"$REPLACE_{w}", "ng_nang") for w in ("nang", "ng")],
    *[(f"$REPLACE_{w}", "enclitic") for w in ("daw", "din", "dito", "diyan", "doon", "raw", "rin", "roon", "rito", "riyan")],
    *[(t, "hyphen") for t in HYPHEN_TAGS],
    *[(t, "space") for t in SPACE_TAGS],
    ("$DELETE", "duplicate_word"),
    *[(f"$TRANSFORM_VERB_{s}", "morphology") for s in ("BASE", "COMPACT", "COMPOBJ", "CONTACT", "CONTOBJ", "INCACT", "INCOBJ", "RECCOMP")],
    *[(f"$ADD_PUNC_{m}", "punctuation") for m in MARKS],
    *[(f"$CHANGE_PUNC_{m}", "punctuation") for m in MARKS],
    ("$TRANSFORM_CASE_CAPITAL", "casing"),
    ("$TRANSFORM_CASE_LOWER", "casing"),
    ("$APPEND_t1", "missing_word"),
    *[(f"$REPLACE_{w}", "pronoun") for w in ("nila", "niya", "sila", "siya")],
]
# --- End of fixed values. ----------------------------------------------------------------------------------------


@dataclass(frozen=True)
class QualityRules:
    max_characters: int | None = 2000
    min_alphabetic_ratio: float = 0.20
    max_repeated_punctuation: int = 4
    required_language: str | None = "FILIPINO"
    min_language_confidence: float | None = 0.80
    min_tokens: int = 8
    min_markers: int = 4
    borderline_ratio: float = 0.50
    max_marker_ratio: float = 0.75
    clause_min_tokens: int = 4
    clause_min_markers: int = 2
    clause_min_content: int = 2
    integrity_min_tokens: int = 1
    boilerplate: tuple[str, ...] = tuple(BOILERPLATE)
    markers: tuple[str, ...] = tuple(MARKERS)
    content: tuple[str, ...] = tuple(CONTENT)
    boundaries: tuple[str, ...] = tuple(BOUNDARIES)
    informal: tuple[str, ...] = tuple(INFORMAL)
    mojibake: tuple[str, ...] = tuple(MOJIBAKE)


@dataclass(frozen=True)
class Profile:
    """One language's vocabulary for the generators and the gate."""

    name: str
    tags: tuple[tuple[str, str], ...]
    swaps: dict[str, str]
    contextual: dict[str, tuple[str, bool]]  # correct -> (wrong, whether correct stands after a vowel or glide)
    exception_words: tuple[str, ...]
    exception_endings: tuple[str, ...]
    pronouns: dict[str, str]
    edit_contexts: tuple[str, ...]
    case_words: tuple[str, ...]
    rules: QualityRules = field(default_factory=QualityRules)
    swap_family: str = "ng_nang"
    folded: bool = True  # whether the end of a word is told without its accents


FILIPINO = Profile("fil", tuple(TAGS), SWAPS, {k: (v, k[0] == "r") for k, v in ENCLITICS.items()}, tuple(ENCLITIC_EXCEPTIONS), tuple(EXCEPTION_ENDINGS), PRONOUNS, tuple(EDIT_CONTEXTS), tuple(FUNCTION_WORDS))

_EN_SWAPS, _EN_PRONOUNS = {"in": "on", "on": "in"}, {"he": "it", "it": "he"}
_EN_CONTEXTUAL = {"for": ("or", False), "or": ("for", True), "at": ("as", False), "as": ("at", True)}
ENGLISH = Profile(
    "en",
    tuple(
        [
            *[(f"$REPLACE_{w}", "swap") for w in _EN_SWAPS],
            *[(f"$REPLACE_{w}", "enclitic") for w in _EN_CONTEXTUAL],
            *[(t, f) for t, f in TAGS if f in ("hyphen", "space", "duplicate_word", "morphology", "punctuation", "casing", "missing_word")],
            *[(f"$REPLACE_{w}", "pronoun") for w in _EN_PRONOUNS],
        ]
    ),
    _EN_SWAPS,
    _EN_CONTEXTUAL,
    ("for", "or"),
    ("re", "ly"),
    _EN_PRONOUNS,
    ("the", "and", "of", "to", "is", "that", "with", "by", "from"),
    ("the", "and", "of", "to", "in", "is", "it", "that", "as", "for", "with", "on", "was", "are", "by"),
    replace(QualityRules(), required_language="EN", min_language_confidence=0.20, max_characters=1200, borderline_ratio=0.30, max_marker_ratio=0.42, boundaries=("that", "with", "from"), content=("the", "and", "of", "is")),
    swap_family="swap",
    folded=False,  # English has no such accents; its queries' SQL takes letters as they are
)
