"""The shapes of values, for expressions of either Python or the JVM."""

# The types that stand in place of values, in the order they are tried; PHONE has ten digits at least.
VALUE_SHAPES = (
    ("EMAIL", r"^[^@\s]+@[^@\s]+\.[A-Za-z]{2,}$"),
    ("MONEY", r"^[$£€]?\s?[0-9,]+\.[0-9]{2}$|^[$£€]\s?[0-9,]+$"),
    ("DATE", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}|^[0-9]{1,2}[/-][0-9]{1,2}[/-][0-9]{2,4}"),
    ("NUM", r"^[0-9]+$"),
    ("PHONE", r"^[0-9\s().+-]{7,20}$"),
)
