"""Code-to-label lookups."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

# Names of the classification sections.
SECTION_LABELS = {
    "A": "Human Necessities",
    "B": "Performing Operations; Transporting",
    "C": "Chemistry; Metallurgy",
    "D": "Textiles; Paper",
    "E": "Fixed Constructions",
    "F": "Mechanical Engineering",
    "G": "Physics",
    "H": "Electricity",
    "Y": "General Tagging (Emerging Tech)",
}

# ISO-2 country code -> (name, ISO-3).
COUNTRIES = {
    "US": ("United States", "USA"),
    "CN": ("China", "CHN"),
    "JP": ("Japan", "JPN"),
    "GB": ("United Kingdom", "GBR"),
    "KR": ("South Korea", "KOR"),
    "IN": ("India", "IND"),
    "DE": ("Germany", "DEU"),
    "FR": ("France", "FRA"),
    "CA": ("Canada", "CAN"),
    "AU": ("Australia", "AUS"),
    "CH": ("Switzerland", "CHE"),
    "NL": ("Netherlands", "NLD"),
    "SE": ("Sweden", "SWE"),
    "IT": ("Italy", "ITA"),
    "ES": ("Spain", "ESP"),
    "BR": ("Brazil", "BRA"),
    "RU": ("Russia", "RUS"),
    "TW": ("Taiwan", "TWN"),
    "SG": ("Singapore", "SGP"),
    "IL": ("Israel", "ISR"),
    "FI": ("Finland", "FIN"),
    "DK": ("Denmark", "DNK"),
    "BE": ("Belgium", "BEL"),
    "AT": ("Austria", "AUT"),
    "IE": ("Ireland", "IRL"),
    "NO": ("Norway", "NOR"),
    "MX": ("Mexico", "MEX"),
    "ZA": ("South Africa", "ZAF"),
    "TR": ("Turkey", "TUR"),
    "PL": ("Poland", "POL"),
    "PT": ("Portugal", "PRT"),
    "NZ": ("New Zealand", "NZL"),
    "MY": ("Malaysia", "MYS"),
    "TH": ("Thailand", "THA"),
    "PH": ("Philippines", "PHL"),
    "ID": ("Indonesia", "IDN"),
    "VN": ("Vietnam", "VNM"),
    "HK": ("Hong Kong", "HKG"),
    "SA": ("Saudi Arabia", "SAU"),
    "AE": ("United Arab Emirates", "ARE"),
}


def lookup(code: Column, labels: dict[str, str]) -> Column:
    """Label of a code, or the code itself when it has none."""
    if not labels:
        return code
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(labels.items())])
    return F.coalesce(F.try_element_at(table, code), code)


def section_label(code: Column) -> Column:
    return lookup(code, SECTION_LABELS)


def coded_section_label(code: Column, length: int | None = None) -> Column:
    """'A — Human Necessities', the label cut to ``length`` characters when given."""
    label = section_label(code)
    if length is not None:
        label = F.substring(label, 1, length)
    return F.concat(code, F.lit(" — "), label)


def country_name(code: Column) -> Column:
    return lookup(code, {k: v[0] for k, v in COUNTRIES.items()})


def country_iso3(code: Column) -> Column:
    return lookup(code, {k: v[1] for k, v in COUNTRIES.items()})
