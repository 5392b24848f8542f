"""Quality rules, line by line first: failing lines go, then texts that lost too much.

All built-in expressions over one row: nothing is shuffled, and no text leaves the JVM.
"""

from pyspark.sql import functions as F

SPACE = " \t\n\x0b\f\r"
SOLID = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
# fixed values: wording of page furniture, in lower case
BOILERPLATE = [
    "all rights reserved",
    "click here",
    "cookie policy",
    "enable javascript",
    "lorem ipsum",
    "privacy policy",
    "powered by",
    "read more",
    "sign up",
    "subscribe to",
    "terms of service",
    "terms of use",
]
SHORT_LINE = 12  # words; a longer line is prose even if it has such a wording
LEAST_KEPT = 0.5  # of the code points in words


def let(value, body):
    """``body`` of a value that is worked out once (an inlined column would be worked out at each use)."""
    return F.transform(F.array(value), body)[0]


def words(text):
    """Runs of anything but ASCII white space."""
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def count_of(text, chars):
    """How many characters of a text are among ``chars`` (none of them special inside brackets)."""
    return F.regexp_count(text, F.lit(f"[{chars}]"))


def solid_of(w):
    """Code points in the words ``w``."""
    return F.length(F.array_join(w, ""))


def repeated_words(w, n=3):
    """Words that lie in an ``n``-word window found twice or more among the words ``w``.

    Windows are compared by a 64-bit hash, brought together by sorting.
    """
    windows = F.when(
        F.size(w) >= n,
        F.transform(
            F.sequence(F.lit(0), F.size(w) - n),
            lambda i: F.struct(F.xxhash64(*[F.get(w, i + k) for k in range(n)]).alias("h"), i.alias("i")),
        ),
    )

    def covered(ordered):
        again = F.filter(
            ordered,
            lambda x, j: F.coalesce(x["h"] == F.get(ordered, j - 1)["h"], F.lit(False))
            | F.coalesce(x["h"] == F.get(ordered, j + 1)["h"], F.lit(False)),
        )
        return let(
            F.array_sort(F.transform(again, lambda x: x["i"])),
            lambda at: F.aggregate(
                F.transform(at, lambda p, j: F.least(F.lit(n), F.coalesce(F.get(at, j + 1) - p, F.lit(n)))),
                F.lit(0).cast("long"),
                lambda a, x: a + x,
            ),
        )

    return F.coalesce(let(F.array_sort(windows), covered), F.lit(0)).cast("long")


def base(docs, text_col="text"):
    """Add ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words`` and ``base_failed``.

    A null or empty text has no words and fails.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(SOLID))
    counts = let(
        words(text),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n"), solid_of(w).cast("long").alias("s"), repeated_words(w).alias("r")
        ),
    )
    out = docs.withColumn("_counts", counts).withColumns(
        {
            "n_words": F.col("_counts.n"),
            "word_chars": F.col("_counts.s"),
            "n_symbols": count_of(text, SYMBOLS).cast("long"),
            "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
            "n_repeat_words": F.col("_counts.r"),
        }
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.withColumn("base_failed", failed).drop("_counts")


def line_fails(line):
    """Whether a line fails a rule; a line without a word fails nothing.

    Punctuation: one symbol or more in five code points, or two exclamation marks for
    every third word, or fewer than four words that nothing ends. Navigation: items
    between two bars or more, one in three words. Boilerplate: a short line with a
    fixed wording.
    """
    return let(words(line), lambda w: _fails(line, solid_of(w), F.size(w)))


def _fails(line, solid, n):
    ended = F.rtrim(F.translate(line, SPACE, " ")).rlike(r"[.!?:;…)\"”»]$")  # looked at in very short lines only
    shouts = (F.length(line) - F.length(F.replace(line, F.lit("!!"), F.lit("")))) / 2
    punctuation = (5 * count_of(line, SYMBOLS) >= solid) | (3 * shouts >= F.greatest(n, F.lit(1))) | ((n < 4) & ~ended)
    bars = count_of(line, "|")
    navigation = (bars >= 2) & (3 * bars >= n - bars)
    # without regard to the case of ASCII letters
    boilerplate = (n <= SHORT_LINE) & line.rlike("(?i)" + "|".join(BOILERPLATE))
    return (n > 0) & (punctuation | navigation | boilerplate)


def clean(docs, text_col="text", least_kept=LEAST_KEPT):
    """``base`` and the line rules: adds ``clean_text``, ``n_lines``, ``n_removed``, ``lost_chars`` and ``kept``.

    ``clean_text`` is the text without the lines that fail; the others stay as they are,
    blank ones too. ``kept``: the base rules hold, and the cleaned text has at least
    ``least_kept`` of the code points in words. A null text has a null ``clean_text`` and is
    not kept. All other columns and repeated rows are passed on; columns of the same
    names as those added are replaced.
    """
    lines = F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")
    judged = let(
        F.transform(
            lines,
            lambda x: let(
                words(x),
                lambda w: let(
                    solid_of(w),
                    lambda solid: F.struct(x.alias("line"), solid.alias("solid"), _fails(x, solid, F.size(w)).alias("fails")),
                ),
            ),
        ),
        lambda all_lines: F.struct(
            F.size(F.filter(all_lines, lambda x: x["solid"] > 0)).alias("lines"),
            F.size(F.filter(all_lines, lambda x: x["fails"])).alias("removed"),
            F.array_join(
                F.transform(F.filter(all_lines, lambda x: ~x["fails"]), lambda x: x["line"]), "\n"
            ).alias("text"),
            F.aggregate(
                all_lines, F.lit(0).cast("long"), lambda a, x: a + F.when(x["fails"], 0).otherwise(x["solid"])
            ).alias("solid"),
        ),
    )
    solid = F.col("_judged.solid")
    return (
        base(docs, text_col)
        .withColumn("_judged", judged)
        .withColumns(
            {
                "clean_text": F.when(F.col(text_col).isNotNull(), F.col("_judged.text")),
                "n_lines": F.col("_judged.lines").cast("long"),
                "n_removed": F.col("_judged.removed").cast("long"),
                "lost_chars": F.col("word_chars") - solid,
                "kept": ~F.col("base_failed") & (solid >= least_kept * F.col("word_chars")),
            }
        )
        .drop("_judged")
    )
