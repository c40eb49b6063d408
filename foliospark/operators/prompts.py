"""Instruction texts. Their wording is a set of fixed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliospark.functions.text import trim_all

#: The lane prompt and instruction, with {} for the lane.
LANE_PROMPT = 'Extract the "{}" lane from this paper.\nWrite 4-8 short bullets as plain text.\nPrioritize empirical evidence and key results where relevant.'
LANE_INSTRUCTION = "You are extracting structured evidence from one research paper.\nFocus lane: {}.\nReturn concise plain text only. Include direct quantitative findings when available.\nDo not produce HTML."
#: The user instruction, with {} for the date and GUIDE for the
#: name of the style guide, that name, and the emphasis.
USER_INSTRUCTION = (
    "Create a JSON explainer for this paper following the skill instructions.",
    "Read the figures and tables as well as the prose. Put value grids (metric × system breakdowns) in `table` blocks; reserve Chart.js charts for genuine trends, relationships, or capability profiles per GUIDE, and prefer a table over a bar chart when in doubt. If the paper has a single standout conceptual figure (visual abstract, architecture overview, taxonomy), emit it as an `image` block per GUIDE; otherwise omit `image`. Never invent figure content.",
    "When a visual detail is unclear, state the uncertainty or omit it rather than guessing.",
    "Use {} as metadata.date_created and as the YYYY-MM-DD prefix of metadata.filename_slug (slug format: YYYY-MM-DD_authorsurname_short-title_explainer).",
    'hero.publication_date must use the format "Published Month Year".',
    "Return only a valid JSON object. The first character must be { and the last must be }. No code fences, no explanation.",
)
GUIDE = "skill.md"
EMPHASIS = ("\n\nREADER EMPHASIS FOR THIS PAPER\n", "\nWeight the pills, sections, and charts toward this angle where the paper supports it. If the paper does not cover it, do not invent content — stay faithful to the source.")


def _filled(template: str, value: Column) -> Column:
    before, after = template.split("{}")
    return F.concat(F.lit(before), value, F.lit(after))


def lane_prompt(lane: Column) -> Column:
    return _filled(LANE_PROMPT, lane)


def lane_instruction(lane: Column) -> Column:
    return _filled(LANE_INSTRUCTION, lane)


def user_instruction(date: Column, hint: Column, guide: str = GUIDE) -> Column:
    """The instruction, with an emphasis block if there is a hint."""
    texts = [x.replace("GUIDE", guide) for x in USER_INSTRUCTION]
    parts = [_filled(x, date) if "{}" in x else F.lit(x) for x in texts]
    base, note = F.concat_ws(" ", *parts), trim_all(hint)
    return F.when(F.length(note) > 0, F.concat(base, F.lit(EMPHASIS[0]), note, F.lit(EMPHASIS[1]))).otherwise(base)
