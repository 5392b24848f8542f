"""SQL text for column lists too long to build one ``Column`` call at a time."""


def quoted(name):
    """A column name as an identifier."""
    return "`" + name.replace("`", "``") + "`"


def text(value):
    """A string as a SQL literal, null for None."""
    if value is None:
        return "cast(null as string)"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def rows(cells):
    """``inline(array(struct(...), ...))`` of struct bodies: one output row per cell."""
    return "inline(array(" + ", ".join(f"struct({c})" for c in cells) + "))"
