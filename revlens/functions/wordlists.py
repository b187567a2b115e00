"""Word lists and lookup tables.

The English stop list equals Spark's own (``StopWordsRemover.loadDefaultStopWords('english')``,
compared in the tests) and is stated here, so that importing needs no file and no JVM.
"""

from __future__ import annotations

import string

# --- fixed values -----------------------------------------------------------------------
# These must equal the reviewed behaviour for results to match; they are stated as text,
# in their natural order.

# ASCII punctuation as defined by Python's ``string.punctuation``.
PUNCTUATION = string.punctuation  # !"#$%&'()*+,-./:;<=>?@[\]^_`{|}~

# Characters the tokenizer separates from an adjacent letter.
TOKEN_PUNCT = ":;()[]+.,!?\\-"

# English contraction map (123 keys, original order). One value differs on purpose:
# "he'll've" expands to "he will have" (the source list has a doubled "he").
CONTRACTION_MAP = {
    "ain't": "is not",
    "aren't": "are not",
    "can't": "cannot",
    "can't've": "cannot have",
    "'cause": "because",
    "could've": "could have",
    "couldn't": "could not",
    "couldn't've": "could not have",
    "didn't": "did not",
    "doesn't": "does not",
    "don't": "do not",
    "hadn't": "had not",
    "hadn't've": "had not have",
    "hasn't": "has not",
    "haven't": "have not",
    "he'd": "he would",
    "he'd've": "he would have",
    "he'll": "he will",
    "he'll've": "he will have",
    "he's": "he is",
    "how'd": "how did",
    "how'd'y": "how do you",
    "how'll": "how will",
    "how's": "how is",
    "I'd": "I would",
    "I'd've": "I would have",
    "I'll": "I will",
    "I'll've": "I will have",
    "I'm": "I am",
    "I've": "I have",
    "i'd": "i would",
    "i'd've": "i would have",
    "i'll": "i will",
    "i'll've": "i will have",
    "i'm": "i am",
    "i've": "i have",
    "isn't": "is not",
    "it'd": "it would",
    "it'd've": "it would have",
    "it'll": "it will",
    "it'll've": "it will have",
    "it's": "it is",
    "let's": "let us",
    "ma'am": "madam",
    "mayn't": "may not",
    "might've": "might have",
    "mightn't": "might not",
    "mightn't've": "might not have",
    "must've": "must have",
    "mustn't": "must not",
    "mustn't've": "must not have",
    "needn't": "need not",
    "needn't've": "need not have",
    "o'clock": "of the clock",
    "oughtn't": "ought not",
    "oughtn't've": "ought not have",
    "shan't": "shall not",
    "sha'n't": "shall not",
    "shan't've": "shall not have",
    "she'd": "she would",
    "she'd've": "she would have",
    "she'll": "she will",
    "she'll've": "she will have",
    "she's": "she is",
    "should've": "should have",
    "shouldn't": "should not",
    "shouldn't've": "should not have",
    "so've": "so have",
    "so's": "so as",
    "that'd": "that would",
    "that'd've": "that would have",
    "that's": "that is",
    "there'd": "there would",
    "there'd've": "there would have",
    "there's": "there is",
    "they'd": "they would",
    "they'd've": "they would have",
    "they'll": "they will",
    "they'll've": "they will have",
    "they're": "they are",
    "they've": "they have",
    "to've": "to have",
    "wasn't": "was not",
    "we'd": "we would",
    "we'd've": "we would have",
    "we'll": "we will",
    "we'll've": "we will have",
    "we're": "we are",
    "we've": "we have",
    "weren't": "were not",
    "what'll": "what will",
    "what'll've": "what will have",
    "what're": "what are",
    "what's": "what is",
    "what've": "what have",
    "when's": "when is",
    "when've": "when have",
    "where'd": "where did",
    "where's": "where is",
    "where've": "where have",
    "who'll": "who will",
    "who'll've": "who will have",
    "who's": "who is",
    "who've": "who have",
    "why's": "why is",
    "why've": "why have",
    "will've": "will have",
    "won't": "will not",
    "won't've": "will not have",
    "would've": "would have",
    "wouldn't": "would not",
    "wouldn't've": "would not have",
    "y'all": "you all",
    "y'all'd": "you all would",
    "y'all'd've": "you all would have",
    "y'all're": "you all are",
    "y'all've": "you all have",
    "you'd": "you would",
    "you'd've": "you would have",
    "you'll": "you will",
    "you'll've": "you will have",
    "you're": "you are",
    "you've": "you have",
}

# Sentiment class names in label order 0, 1, 2.
CLASS_NAMES = ["negative", "neutral", "positive"]
# Star rating -> sentiment string (1, 2 negative; 3 neutral; 4, 5 positive).
RATING_TO_SENTIMENT = {1: "Negative", 2: "Negative", 3: "Neutral", 4: "Positive", 5: "Positive"}
# Star rating -> class id used by the dataset preparation.
RATING_TO_LABEL = {1: 0, 2: 0, 3: 1, 4: 2, 5: 2}
# Class id {0,1,2} <-> polarity {-1,0,1}.
LABEL_TO_POLARITY = {0: -1, 1: 0, 2: 1}
POLARITY_TO_LABEL = {-1: 0, 0: 1, 1: 2}
# ---------------------------------------------------------------------------------------


def lower_contractions() -> dict[str, str]:
    """Whole-word lookup table keyed by the lower-cased contraction.

    Where two keys differ only in case (``I'd`` / ``i'd``) the lower-case entry wins; the
    case of the first letter is restored by the caller.
    """
    out: dict[str, str] = {}
    for k, v in CONTRACTION_MAP.items():
        lk = k.lower()
        if lk not in out or k == lk:
            out[lk] = v.lower() if k != lk else v
    return out


# Spark's default English stop list (181 words, Apache Spark, ml.feature).
ENGLISH_STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you your yours yourself yourselves he him his himself
    she her hers herself it its itself they them their theirs themselves what which who whom
    this that these those am is are was were be been being have has had having do does did doing
    a an the and but if or because as until while of at by for with about against between into
    through during before after above below to from up down in out on off over under again
    further then once here there when where why how all any both each few more most other some
    such no nor not only own same so than too very s t can will just don should now i'll you'll
    he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're
    they're i've we've you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't
    doesn't didn't won't wouldn't shan't shouldn't mustn't can't couldn't cannot could here's
    how's let's ought that's there's what's when's where's who's why's would
    """.split()
)


def spark_stop_words(language: str = "english") -> tuple[str, ...]:
    """Spark's default English stop list, kept here so that no file is read at import.

    Other languages come from ``StopWordsRemover.loadDefaultStopWords`` in a live session.
    """
    if language == "english":
        return ENGLISH_STOP_WORDS
    from pyspark.ml.feature import StopWordsRemover

    return tuple(StopWordsRemover.loadDefaultStopWords(language))


def extended_stop_words() -> tuple[str, ...]:
    """English stop words plus the single letters b..z (the quick profile list, T14)."""
    return spark_stop_words("english") + tuple(string.ascii_lowercase[1:])
