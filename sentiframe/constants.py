"""Fixed values.

Everything in this module is a constant that must equal the values the
original labelled-text project uses, or results would differ: label lists,
label mappings, the stopword list, punctuation sets and rule word lists.
They are stated plainly, in their natural order.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES: the 28 fine-grained emotion labels; list position is the id.
# ---------------------------------------------------------------------------
EMOTIONS = [
    "admiration", "amusement", "anger", "annoyance", "approval", "caring",
    "confusion", "curiosity", "desire", "disappointment", "disapproval",
    "disgust", "embarrassment", "excitement", "fear", "gratitude", "grief",
    "joy", "love", "nervousness", "optimism", "pride", "realization",
    "relief", "remorse", "sadness", "surprise", "neutral",
]

# FIXED VALUES: the four moods, in model/report order (id = position).
MOOD_LABELS = ["happy", "sad", "angry", "neutral"]

# FIXED VALUES: many-to-one emotion -> mood mapping (11 emotions are unmapped).
EMOTION_TO_MOOD = {
    "joy": "happy",
    "amusement": "happy",
    "excitement": "happy",
    "love": "happy",
    "gratitude": "happy",
    "optimism": "happy",
    "admiration": "happy",
    "sadness": "sad",
    "grief": "sad",
    "disappointment": "sad",
    "remorse": "sad",
    "embarrassment": "sad",
    "anger": "angry",
    "annoyance": "angry",
    "disapproval": "angry",
    "disgust": "angry",
    "neutral": "neutral",
}

# FIXED VALUES: stopwords dropped by the aggressive cleaner (56 words).
STOPWORDS = [
    "the", "is", "am", "are", "a", "an", "and", "to", "of", "in", "it",
    "this", "that", "for", "on", "with", "as", "was", "were", "be",
    "been", "being", "i", "im", "ive", "me", "my", "you", "your", "he",
    "she", "they", "them", "we", "our", "at", "by", "from", "or", "if",
    "but", "so", "do", "does", "did", "have", "has", "had", "just",
    "very", "can", "could", "would", "should", "will", "today",
]

# FIXED VALUES: the 32 ASCII punctuation characters (Python string.punctuation).
ASCII_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# FIXED VALUES: extra characters the analysis tokenizer also treats as
# punctuation; '#' is then removed from the combined set.
EXTRA_ANALYSIS_PUNCTUATION = "’‘–—~|“”…'`_"

ANALYSIS_PUNCTUATION = "".join(
    sorted((set(ASCII_PUNCTUATION) | set(EXTRA_ANALYSIS_PUNCTUATION)) - {"#"}))

# FIXED VALUES: six-way emotion grouping (group -> members), in file order.
EKMAN_MAPPING = {
    "anger": ["anger", "annoyance", "disapproval"],
    "disgust": ["disgust"],
    "fear": ["fear", "nervousness"],
    "joy": ["joy", "amusement", "approval", "excitement", "gratitude", "love",
            "optimism", "relief", "pride", "admiration", "desire", "caring"],
    "sadness": ["sadness", "disappointment", "embarrassment", "grief", "remorse"],
    "surprise": ["surprise", "realization", "confusion", "curiosity"],
}

# FIXED VALUES: sentiment grouping of the emotions.
SENTIMENT_MAPPING = {
    "positive": ["amusement", "excitement", "joy", "love", "desire", "optimism",
                 "caring", "pride", "admiration", "gratitude", "relief", "approval"],
    "negative": ["fear", "nervousness", "remorse", "embarrassment",
                 "disappointment", "sadness", "grief", "disgust", "anger",
                 "annoyance", "disapproval"],
    "ambiguous": ["realization", "surprise", "curiosity", "confusion"],
}

# FIXED VALUES: word lists of the four post-processing override rules, in
# rule order (first hit wins).
RULE_NEGATORS = ["not", "never", "no"]
RULE_INTENSIFIERS = ["so", "very", "really"]
RULE_CONTRASTS = ["but", "though", "although", "however"]
RULE_NEGATIVE_WORDS = ["empty", "tired", "sad", "lonely", "depressed", "terrible",
                       "awful", "hurt", "crying", "miserable"]
RULE_WAIT_WORDS = ["waited", "waiting", "wasted"]
RULE_CANCEL_WORDS = ["cancelled", "canceled", "cancel", "last minute", "late", "ignored"]

# FIXED VALUES: defaults of the pipeline.
SPLIT_SEED = "42"
TEST_SIZE = 0.2
VALIDATION_SIZE = 0.1
MAX_SEQ_LEN = 128
MULTILABEL_THRESHOLD = 0.3
AGREEMENT_MIN = 2
LOG_ODDS_MIN_Z = 3.0

# FIXED VALUES: model configurations of the two TF-IDF + logistic-regression experiments.
BASELINE_CONFIG = {
    "experiment": "Baseline_Unigram_TFIDF_LogReg",
    "word": {"ngram": (1, 1), "max_features": 10000, "min_df": 1, "max_df": 1.0,
             "sublinear": False},
    "C": 1.0, "max_iter": 1000,
}
FINAL_CONFIG = {
    "experiment": "Final_WordChar_TFIDF_LogReg_C15",
    "word": {"ngram": (1, 2), "max_features": 60000, "min_df": 1, "max_df": 0.95,
             "sublinear": True},
    "char": {"ngram": (3, 5), "max_features": 70000, "min_df": 2, "max_df": 0.95,
             "sublinear": True},
    "C": 1.5, "max_iter": 3000,
}
