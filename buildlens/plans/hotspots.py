"""Report rows of security hotspots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import report_text

# Names of categories, and of languages by extension.
CATEGORIES = {
    "dos": "Denial of Service (DoS)", "sql-injection": "SQL Injection", "xss": "Cross-Site Scripting (XSS)", "csrf": "Cross-Site Request Forgery (CSRF)",
    "ssrf": "Server-Side Request Forgery (SSRF)", "open-redirect": "Open Redirect", "xpath-injection": "XPath Injection", "log-injection": "Log Injection",
    "ldap-injection": "LDAP Injection", "command-injection": "Command Injection", "path-traversal-injection": "Path Traversal", "weak-cryptography": "Weak Cryptography",
    "auth": "Authentication", "insecure-conf": "Insecure Configuration", "file-manipulation": "File Manipulation", "others": "Others", "object-injection": "Object Injection",
    "http-response-splitting": "HTTP Response Splitting", "encryption-of-sensitive-data": "Encryption of Sensitive Data", "traceability": "Traceability",
    "permission": "Permission", "buffer-overflow": "Buffer Overflow",
}
LANGUAGES = {
    "js": "JavaScript", "ts": "TypeScript", "py": "Python", "java": "Java", "cs": "C#", "cpp": "C++", "cc": "C++", "cxx": "C++", "c": "C", "h": "C/C++", "hpp": "C++",
    "php": "PHP", "rb": "Ruby", "go": "Go", "kt": "Kotlin", "swift": "Swift", "html": "HTML", "xml": "XML", "sh": "Shell", "scala": "Scala", "rs": "Rust",
}


def _named(key: F.Column, names: dict[str, str], other: F.Column) -> F.Column:
    return F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for pair in names.items() for x in pair)), key), other)


def report(hotspots: DataFrame, project_key: str) -> DataFrame:
    """Eleven text columns a hotspot, safe for a spreadsheet's cells; a missing value is empty.

    ``hotspots``: ruleKey, message, securityCategory, vulnerabilityProbability, component, line, status, resolution.
    """
    component = F.coalesce("component", F.lit(""))
    ext = F.when(component.contains("."), F.lower(F.regexp_extract(component, r"([^.]*)$", 1))).otherwise("")
    language = F.when(ext == "", "Unknown").otherwise(_named(ext, LANGUAGES, F.upper(ext)))
    prefix = F.lit(f"{project_key}:")
    path = F.when(component.startswith(prefix), F.substr(component, F.length(prefix) + 1)).otherwise(component)
    severity = F.when(F.col("vulnerabilityProbability") == "HIGH", "CRITICAL").when(F.col("vulnerabilityProbability") == "MEDIUM", "MAJOR").otherwise("MINOR")
    kind = F.coalesce("securityCategory", F.lit(""))
    columns = {
        "rule": F.col("ruleKey"), "message": F.col("message"), "category": _named(kind, CATEGORIES, kind), "probability": F.col("vulnerabilityProbability"), "severity": severity,
        "language": language, "file": path, "line": F.col("line").cast("string"), "status": F.col("status"), "resolution": F.col("resolution"), "comments": F.lit(""),
    }
    return hotspots.select(*(F.coalesce(report_text(c), F.lit("")).alias(k) for k, c in columns.items()))
