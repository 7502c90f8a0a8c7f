"""Places as providers report them: regions and countries by name or code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orebody.functions.text import normalize_text

# Regions of the United States and Canada by normalised name.
REGIONS = {
    "alabama": "AL", "alaska": "AK", "arizona": "AZ", "arkansas": "AR", "california": "CA", "colorado": "CO", "connecticut": "CT",
    "delaware": "DE", "district of columbia": "DC", "florida": "FL", "georgia": "GA", "hawaii": "HI", "idaho": "ID", "illinois": "IL",
    "indiana": "IN", "iowa": "IA", "kansas": "KS", "kentucky": "KY", "louisiana": "LA", "maine": "ME", "maryland": "MD",
    "massachusetts": "MA", "michigan": "MI", "minnesota": "MN", "mississippi": "MS", "missouri": "MO", "montana": "MT",
    "nebraska": "NE", "nevada": "NV", "new hampshire": "NH", "new jersey": "NJ", "new mexico": "NM", "new york": "NY",
    "north carolina": "NC", "north dakota": "ND", "ohio": "OH", "oklahoma": "OK", "oregon": "OR", "pennsylvania": "PA",
    "rhode island": "RI", "south carolina": "SC", "south dakota": "SD", "tennessee": "TN", "texas": "TX", "utah": "UT",
    "vermont": "VT", "virginia": "VA", "washington": "WA", "west virginia": "WV", "wisconsin": "WI", "wyoming": "WY",
    "alberta": "AB", "british columbia": "BC", "manitoba": "MB", "new brunswick": "NB", "newfoundland and labrador": "NL",
    "northwest territories": "NT", "nova scotia": "NS", "nunavut": "NU", "ontario": "ON", "prince edward island": "PE",
    "quebec": "QC", "québec": "QC", "saskatchewan": "SK", "yukon": "YT",
}
# Countries by normalised name.
COUNTRIES = {
    "us": "US", "u s": "US", "usa": "US", "u s a": "US", "united states": "US", "united states of america": "US", "america": "US",
    "ca": "CA", "can": "CA", "canada": "CA", "mx": "MX", "mex": "MX", "mexico": "MX", "méxico": "MX",
    "gb": "GB", "uk": "GB", "united kingdom": "GB",
}


def _lookup(text: Column, known: dict[str, str]) -> Column:
    pairs = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    return F.coalesce(pairs[text], F.upper(text))


def region_code(value: Column) -> Column:
    """The code of a region given by name or code; other text in upper case; null for null and blank."""
    return _lookup(normalize_text(value), REGIONS)


def country_code(value: Column) -> Column:
    """The code of a country given by name or code; other text in upper case; null for null and blank."""
    return _lookup(normalize_text(value), COUNTRIES)


def location(city: Column, region: Column, postal: Column, country: Column) -> Column:
    """The parts that are known, joined by commas; null when none is."""
    return F.nullif(F.concat_ws(", ", city, region, F.upper(postal), country), F.lit(""))
