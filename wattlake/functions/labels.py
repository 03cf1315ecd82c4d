"""Labels told from words: ordered keyword rules, exact maps, groups of customers and titles, as native columns.

Null text reads as the empty text and gives no label.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

# Categories of technologies, by what a source calls them.
CATEGORIES = {
    "lighting": "Lighting", "hvac": "HVAC", "building envelope": "Weatherization", "appliances": "Appliances", "solar technologies": "Solar", "wind": "Wind",
    "geothermal technologies": "Geothermal", "industrial equipment": "Industrial Equipment", "processing and manufacturing equipment": "Industrial Equipment",
    "electric vehicles": "Electric Vehicles", "water heating": "Water Heating", "energy storage": "Energy Storage", "renewables": "Renewable Energy",
    "renewable energy": "Renewable Energy", "alternative fuel vehicles": "Alternative Fuel Vehicles", "combined heat & power": "Combined Heat & Power",
    "combined heat and power": "Combined Heat & Power", "chp": "Combined Heat & Power", "biomass": "Biomass", "fuel cells": "Fuel Cells",
    "comprehensive measures/whole building": "Whole Building", "whole building": "Whole Building", "other ee": "Other", "other": "Other",
}
# Keywords of technologies, the first that occurs counts.
TECHNOLOGIES = (
    ("Solar", ("solar photovoltaic", "solar pv")), ("Water Heating", ("solar water heat", "solar thermal")), ("Solar", ("solar",)), ("Wind", ("wind",)), ("Geothermal", ("geothermal",)),
    ("HVAC", ("heat pump", "air condition", "furnace", "boiler", "hvac")), ("Water Heating", ("water heat", "water heater", "tankless")),
    ("Weatherization", ("insulation", "weatheri", "caulk", "air seal", "duct seal", "window")), ("Lighting", ("led", "lighting")),
    ("Electric Vehicles", ("electric vehicle", "ev charger", "evse")), ("Energy Storage", ("battery", "energy storage")), ("Appliances", ("refrigerat", "appliance")),
    ("Biomass", ("biomass",)), ("Fuel Cells", ("fuel cell",)), ("Combined Heat & Power", ("combined heat",)), ("Whole Building", ("whole building", "comprehensive")),
)
# Formats told by the type of a program.
TYPE_FORMATS = (("financing", ("loan",)), ("tax_credit", ("tax credit",)), ("tax_deduction", ("tax deduction",)), ("tax_exemption", ("tax exemption",)), ("performance", ("performance",)), ("dollar_amount", ("grant",)))
# Words of the names of state agencies.
AGENCIES = ("department of", "energy office", "state of ", " state gov", "division of", "bureau of", "commission on", "authority", "public utilities commission", " puc", " psc")
# Portfolios of categories, the first one counts, and their codes.
PORTFOLIOS = {
    "HVAC": ("Energy Efficiency",), "Weatherization": ("Energy Efficiency",), "Lighting": ("Energy Efficiency",), "Appliances": ("Energy Efficiency",), "Water Heating": ("Energy Efficiency",),
    "Industrial Equipment": ("Energy Efficiency",), "Whole Building": ("Energy Efficiency",), "Smart Thermostat": ("Energy Efficiency", "Demand Response"),
    "Solar": ("Distributed Energy Resources",), "Geothermal": ("Distributed Energy Resources",), "Energy Storage": ("Distributed Energy Resources",), "Wind": ("Distributed Energy Resources",),
    "Biomass": ("Distributed Energy Resources",), "Fuel Cells": ("Distributed Energy Resources",), "Combined Heat & Power": ("Distributed Energy Resources",), "Renewable Energy": ("Distributed Energy Resources",),
    "Electric Vehicles": ("Electric Vehicles",), "Alternative Fuel Vehicles": ("Electric Vehicles",), "Demand Response": ("Demand Response",), "Electrification": ("Building Electrification",),
    "Income Qualified": ("Income Qualified",), "Financing": ("Financing",),
}
PORTFOLIO_CODES = {"Energy Efficiency": "EE", "Distributed Energy Resources": "DER", "Demand Response": "DR", "Electric Vehicles": "EV", "Income Qualified": "LMI", "Financing": "FIN", "Building Electrification": "BE", "Rates": "RATES"}
# Words of an address or a title, and phrases of a text, that tell the group of customers.
HOME_WORDS, BUSINESS_WORDS = ("residential", "/home", "homeowner", "renter"), ("business", "commercial", "industrial", "multifamily")
HOME_PHRASES = (
    "residential customers", "residential customer", "for homeowners", "for renters", "for your home", "home energy", "single-family", "multifamily residential", "apartment residents",
    "residential program", "residential rebate", "residential rate", "residential electricity", "qualifying households", "eligible households",
)
BUSINESS_PHRASES = (
    "business customers", "business customer", "commercial customers", "commercial customer", "for your business", "non-residential", "commercial buildings", "commercial building", "small business",
    "commercial and industrial", "c&i customers", "business program", "commercial program", "business rebate", "commercial rebate", "commercial electricity", "eligible businesses", "qualifying businesses",
)
# Words for who receives a payment, the first that occurs counts.
RECIPIENTS = (("Homeowner", ("homeowner",)), ("Renter", ("renter", "tenant")), ("Landlord", ("landlord",)), ("Small Business Owner", ("small business",)), ("Business Owner", ("business",)))
# Titles that are no program, phrases of paragraphs that are no description, parts of addresses of images that are no picture, and rows that are no program.
NO_TITLE = (
    "page not found", "404", "error", "site map", "home", "login", "log in", "sign in", "extra verification", "two-factor", "verify your identity", "we welcome your feedback", "welcome your feedback",
    "access denied", "403 forbidden", "session expired", "account suspended", "permission denied",
)
NO_PARAGRAPH = ("unsupported browser", "please download the latest version of chrome", "please download the latest version of firefox", "download the latest version of chrome, firefox", "error: please call us at")
NO_IMAGE = ("logo", "icon", "favicon", "sprite", "arrow", "chevron", "button", "badge", "avatar", "placeholder", "tracking", "pixel", ".svg", "data:image")
# What a page that asks for a check of the browser says.
CHALLENGE = ("just a moment", "cf-challenge-running", "challenge-platform", "checking your browser")


def _low(text: Column) -> Column:
    return F.lower(F.coalesce(text, F.lit("")))


def any_word(text: Column, words: Sequence[str]) -> Column:
    """Whether one of the words occurs as a substring, case ignored."""
    t = _low(text)
    out = F.lit(False)
    for w in words:
        out = out | t.contains(w)
    return out


def first_rule(text: Column, rules: Sequence[tuple[str, Sequence[str]]]) -> Column:
    """The label of the first rule one of whose words occurs; null if there is none."""
    out = F.lit(None).cast("string")
    for label, words in reversed(rules):
        out = F.when(any_word(text, words), F.lit(label)).otherwise(out)
    return out


def mapped(text: Column, labels: Mapping[str, str]) -> Column:
    """The label of the whole text, case ignored; null if it has none."""
    by = F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])
    return F.try_element_at(by, _low(text))


def groups_of(place: Column, body: Column, most: int = 2000) -> Column:
    """Residential, Commercial or both, by the words of an address and title, else by the phrases in the first ``most`` characters of a text; null if neither tells."""

    def told(home: Column, business: Column) -> Column:
        return F.when(home & business, "Residential, Commercial").when(business, "Commercial").when(home, "Residential")

    head = F.substring(F.coalesce(body, F.lit("")), 1, most)
    return F.coalesce(told(any_word(place, HOME_WORDS), any_word(place, BUSINESS_WORDS)), told(any_word(head, HOME_PHRASES), any_word(head, BUSINESS_PHRASES)))


def titled(key: Column) -> Column:
    """Words of a key with underscores, each with its first letter in upper case; the other letters stay as they are."""
    parts = F.split(F.replace(key, F.lit("_"), F.lit(" ")), r"(?<=[^\p{L}])(?=\p{L})")
    return F.array_join(F.transform(parts, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1 << 20))), "")


def before_dash(name: Column) -> Column:
    """What stands before the first spaced dash of a name, long dashes first; null if nothing does."""
    out = F.lit(None).cast("string")
    for d in (" - ", " — "):
        out = F.when(F.instr(name, d) > 1, F.trim(F.substring_index(name, d, 1))).otherwise(out)
    return out


def level_of(organisation: Column, nationwide: Column) -> Column:
    """Federal (nationwide, or no organisation), State (the words of an agency) or Utility."""
    return F.when(nationwide | (F.trim(F.coalesce(organisation, F.lit(""))) == ""), "Federal").when(any_word(organisation, AGENCIES), "State").otherwise("Utility")


def portfolio_of(category: Column) -> Column:
    """The first portfolio of a category, letter case counted; null if it has none."""
    return F.try_element_at(F.create_map(*[F.lit(x) for k, v in PORTFOLIOS.items() for x in (k, v[0])]), category)


def cut(text: Column, most: int, mark: str = "…") -> Column:
    """A text of more than ``most`` characters cut to that length with ``mark`` at its end."""
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most - 1), F.lit(mark))).otherwise(text)


# Categories of items, names of items that their keys don't spell, how payments are made, and how to apply, in the order in which they count.
ITEM_CATEGORIES = {
    "Electric Vehicles": ("electric_vehicle_charger", "electric_vehicle", "ebike"),
    "HVAC": ("heat_pump", "heat_pump_air_to_air", "heat_pump_mini_split", "ductless_heat_pump", "central_air_conditioner", "geothermal_heating_installation", "geothermal"),
    "Water Heating": ("heat_pump_water_heater", "non_heat_pump_water_heater"), "Electrical": ("electric_panel", "electric_wiring", "electric_panel_upgrade"),
    "Weatherization": ("weatherization", "insulation_air_sealing", "insulation", "air_sealing", "efficient_windows_skylights_doors"), "Solar": ("rooftop_solar_panels", "rooftop_solar", "community_solar"),
    "Energy Storage": ("battery_storage_installation", "battery_storage"), "Appliances": ("electric_stove", "heat_pump_clothes_dryer"),
}
ITEM_NAMES = {
    "heat_pump_air_to_air": "Air-to-Air Heat Pump", "heat_pump_mini_split": "Mini-Split Heat Pump", "weatherization": "Weatherization / Insulation", "insulation_air_sealing": "Weatherization / Insulation",
    "rooftop_solar_panels": "Rooftop Solar", "battery_storage_installation": "Energy Storage", "battery_storage": "Energy Storage", "ebike": "E-Bike",
    "geothermal_heating_installation": "Geothermal Heat Pump", "geothermal": "Geothermal Heat Pump", "efficient_windows_skylights_doors": "Efficient Windows, Skylights & Doors",
    "non_heat_pump_water_heater": "Water Heater (Non-Heat Pump)",
}
PAYMENT_NAMES = {"pos_rebate": "Point of Sale Rebate"}
APPLY_BY_PAYMENT = (
    ("pos_rebate", "Discount applied at point of sale through participating retailers or contractors."),
    ("tax_credit", "Claim when filing federal taxes using the relevant IRS form. Consult a tax professional for guidance."),
    ("rebate", "Apply through the program website. Check eligibility requirements before purchasing equipment."),
    ("account_credit", "Contact your utility to enroll. Credits will be applied to your account statement."),
    ("assistance_program", "Apply through the program website. Income verification may be required."),
)


def item_name(key: Column) -> Column:
    """The name of an item: a fixed one, else its key as a title."""
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in ITEM_NAMES.items() for x in kv]), key), titled(key))


def item_category(key: Column) -> Column:
    by = {k: c for c, ks in ITEM_CATEGORIES.items() for k in ks}
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in by.items() for x in kv]), key), titled(key))


def payment_name(key: Column) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in PAYMENT_NAMES.items() for x in kv]), key), titled(key))


def apply_by(methods: Column, default: str) -> Column:
    """How to apply, by the first of the known payments that is among a list's."""
    out = F.lit(default)
    for m, text in reversed(APPLY_BY_PAYMENT):
        out = F.when(F.array_contains(methods, m), F.lit(text)).otherwise(out)
    return out


def owners_of(statuses: Column) -> Column:
    """Residential, Commercial or both, by who may own; null for neither."""
    s = F.transform(statuses, F.lower)
    parts = F.array(F.when(F.arrays_overlap(s, F.array(F.lit("homeowner"), F.lit("renter"))), "Residential"), F.when(F.arrays_overlap(s, F.array(F.lit("business"), F.lit("commercial_industrial"), F.lit("commercial"))), "Commercial"))
    out = F.array_join(F.filter(parts, lambda x: x.isNotNull()), ", ")
    return F.when(out != "", out)
