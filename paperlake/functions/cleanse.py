"""Column expressions that clean snapshot records."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from paperlake import constants as K


def collapse_spaces(text: Column) -> Column:
    """Any run of ASCII whitespace becomes one blank; the ends are trimmed."""
    return F.trim(F.regexp_replace(text, K.SPACES, " "))


def clean_title(title: Column) -> Column:
    # Line breaks and tabs are whitespace, so one pass does the work of two.
    return collapse_spaces(title)


def clean_abstract(abstract: Column) -> Column:
    """Strip LaTeX from running text; the order of the steps is part of the result."""
    one_line = F.regexp_replace(abstract, K.LINE_BREAKS, " ")
    no_math = F.regexp_replace(one_line, K.LATEX_MATH, K.MATH_TOKEN)
    no_arguments = F.regexp_replace(no_math, K.LATEX_COMMAND_WITH_ARGUMENT, "")
    no_commands = F.regexp_replace(no_arguments, K.LATEX_COMMAND, "")
    printable = F.regexp_replace(no_commands, K.CONTROL_CHARACTERS, "")
    return collapse_spaces(F.translate(printable, "{}", "()"))


def clean_categories(categories: Column) -> Column:
    return F.regexp_replace(F.trim(categories), K.SPACES, ", ")


def author_names(parsed: Column) -> Column:
    """`[[family, given, suffix], ...]` to `given family, ...`; null stays null."""

    def full_name(entry: Column) -> Column:
        part = lambda i: F.coalesce(F.get(entry, F.lit(i)), F.lit(""))
        return F.trim(F.concat(part(1), F.lit(" "), part(0)))

    return F.array_join(F.transform(parsed, full_name), ", ")


def iso_date(text: Column) -> Column:
    """A date, or null for anything that is not `yyyy-MM-dd` (no error under ANSI)."""
    return F.try_to_date(text, "yyyy-MM-dd")


def paper_url(paper_id: Column) -> Column:
    return F.concat(F.lit(K.URL_PREFIX), paper_id)
