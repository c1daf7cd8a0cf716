"""Model request projections (S7, S8) as column expressions.

The reference sends these texts to remote models; here they are produced
as columns (and a JSON request body) so a separate, rate-limited client can
ship them, and the answers come back as a table (see S9).
"""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

from .strings import col_, truthy_str

# ---- fixed values (must equal the reference's behaviour) -------------------
EXTRACTION_TEXT_CAP = 8000
EXTRACTION_TEMPERATURE = 0.1
EXTRACTION_SYSTEM_PROMPT = (
    "You are a data extraction assistant specialized in data center news. "
    "Return only valid JSON and no surrounding markdown."
)
# Slots are in braces, as for str.format.
EXTRACTION_USER_PROMPT = """
        Analyze this article:
        Title: {title}
        Summary: {summary}
        Full text excerpt: {excerpt}
        
        Extract the following fields in JSON:
        - summary: 2-4 sentences.
        - mentions_cooling_or_water: boolean
        - cooling_water_summary: string or null
        - people: list of {{full_name, primary_title, primary_company, lead_relevance (High/Medium/Low), notes}}
        - companies: list of {{name, sector, country, notes}}
        - country: string or null
        
        Ensure valid JSON.
        """
BRIEFING_DEFAULT_TITLE = "No Title"
BRIEFING_DEFAULT_CONTENT = "No Content"
BRIEFING_PROMPT = """
        Analyze the following news article and provide a JSON output.
        
        Article Title: {title}
        Article Content: {content}

        Output JSON format:
        {{
            "summary": "3 sentences summary of the article",
            "author": "Name of the author if available, else 'Unknown'",
            "entities": ["List of key companies or organizations mentioned, with a brief connection bio in parentheses, e.g., 'Google (Tech Giant)'"],
            "relevance_score": <integer between 1 and 10 indicating relevance to tech/AI/business news>
        }}
        
        Ensure the output is valid JSON. Do not include markdown formatting like ```json ... ```.
        """
# -----------------------------------------------------------------------------


def template_parts(template: str) -> list[tuple[str, str | None]]:
    """(text, the slot behind it or None) of a ``str.format`` template."""
    return [(text, slot) for text, slot, _, _ in Formatter().parse(template)]


def _render(template: str, **cols: Column) -> Column:
    """A template whose slots are filled by columns."""
    parts = [p for text, slot in template_parts(template) for p in
             ([F.lit(text)] if slot is None else [F.lit(text), cols[slot]])]
    return F.concat(*parts)


def _py_format(c: Column) -> Column:
    """f-string rendering of an optional str: None prints as 'None'."""
    return F.coalesce(c, F.lit("None"))


def extraction_user_prompt(title, summary, full_text) -> Column:
    excerpt = F.substring(F.coalesce(col_(full_text), F.lit("")), 1, EXTRACTION_TEXT_CAP)
    return _render(EXTRACTION_USER_PROMPT, title=_py_format(col_(title)),
                   summary=_py_format(col_(summary)), excerpt=excerpt)


def extraction_request(model, title, summary, full_text) -> Column:
    """Chat-completions request body as JSON text."""
    msgs = F.array(
        F.struct(F.lit("system").alias("role"), F.lit(EXTRACTION_SYSTEM_PROMPT).alias("content")),
        F.struct(F.lit("user").alias("role"), extraction_user_prompt(title, summary, full_text).alias("content")))
    return F.to_json(F.struct(F.lit(model).alias("model"), msgs.alias("messages"),
                              F.lit(EXTRACTION_TEMPERATURE).alias("temperature")))


def briefing_prompt(title, content, description) -> Column:
    """Title default 'No Title'; content = first non-empty of content,
    description, 'No Content'."""
    c, d = col_(content), col_(description)
    body = F.when(truthy_str(c), c).when(truthy_str(d), d).otherwise(F.lit(BRIEFING_DEFAULT_CONTENT))
    return _render(BRIEFING_PROMPT, title=F.coalesce(col_(title), F.lit(BRIEFING_DEFAULT_TITLE)),
                   content=body)
