"""Image paths, extensions and padding arithmetic."""

from pyspark.sql import functions as F

# --- fixed values ---
EXTENSIONS = ["jpg", "jpeg", "dcm", "dicom"]


def _text(c):
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def check_ext(ext):
    """Normalised extension (no dot, lower case); an unknown one is an error."""
    plain = ext.lower().lstrip(".")
    if plain not in EXTENSIONS:
        raise ValueError(
            f"Extension {ext} is not supported. Known ones: {', '.join(EXTENSIONS)}"
        )
    return plain


def is_dicom(ext):
    return check_ext(ext) in ("dcm", "dicom")


def ext_of(path):
    """Lower-case extension of a file name or of a bare extension."""
    return F.lower(F.regexp_extract(_text(path), r"([^./]*)$", 1))


def has_known_ext(path):
    return ext_of(path).isin(EXTENSIONS)


def path(base, subject, study, image, ext):
    """``base/pNN/pSUBJECT/sSTUDY/IMAGE.ext``, NN the first two digits of the subject."""
    check_ext(ext)
    subject = _text(subject)
    return F.concat(
        F.lit(base.rstrip("/") + "/p"),
        F.substring(subject, 1, 2),
        F.lit("/p"),
        subject,
        F.lit("/s"),
        _text(study),
        F.lit("/"),
        _text(image),
        F.lit("." + ext.lstrip(".")),
    )


def url(base, subject, study, image, ext="jpg"):
    """Download address of one image; the same layout under a web root."""
    return path(base, subject, study, image, ext)


def pad_plan(h, w):
    """Padding that makes an ``h`` x ``w`` image square, as a struct.

    The odd pixel goes to the right or the bottom.
    """
    h = F.col(h) if isinstance(h, str) else h
    w = F.col(w) if isinstance(w, str) else w
    side = F.greatest(h, w)

    def halves(extent):
        gap = side - extent
        first = F.floor(gap / F.lit(2)).cast("long")
        return first, (gap - first).cast("long")

    left, right = halves(w)
    top, bottom = halves(h)
    return F.struct(
        left.alias("left"), right.alias("right"), top.alias("top"), bottom.alias("bottom")
    )
