"""Settings that both sides of a check share."""

STOP_WORDS = (
    "the", "of", "and", "to", "in", "a", "is", "that", "it", "for",
    "on", "as", "was", "with", "by", "this", "are", "from", "at", "be",
)
AS_OF_YEAR = 2024
QUERY_TEXT = "Tion ouch rewh that und"
SWEEP_LIMIT = 50
GROWTH_SIZES = (10, 25, 50)
MODES = ("click", "error", "purchase", "signup", "view")
