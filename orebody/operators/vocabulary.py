"""What evidence says of a company, as words and patterns: fixed values that decide which facts a clause supports."""

from __future__ import annotations

# The facts, in their order.
FACT_KEYS = (
    "pvf_relevant", "pvf_product_breadth", "industrial_or_process_customer_focus", "branch_count", "inside_sales_or_estimating_presence",
    "rfq_or_quote_workflow_evidence", "project_or_tender_business", "bom_or_line_item_complexity", "manufacturer_count_or_breadth", "relevant_hiring",
    "employee_count", "revenue_if_reliably_available", "regional_independent_signal", "multi_location_signal", "known_current_direct_competitor_customer",
    "known_competitor_evaluation_history", "known_quote_automation_or_order_automation_relationship", "direct_quotation_pain_evidence",
    "manual_workflow_evidence", "explicit_process_bottleneck_evidence",
)
# For each fact groups of alternative patterns; a clause speaks of the fact when every group has a match.
PREDICATES: dict[str, tuple[tuple[str, ...], ...]] = {
    "pvf_relevant": (
        (r"\b(?:sell|sells|selling|distribut(?:e|es|ing)|offer(?:s|ing)?|supply|supplies|stock(?:s|ing)?|carry|carries)\b",),
        (r"\b(?:pvf|pipe|piping|valves?|fittings?)\b",),
    ),
    "pvf_product_breadth": ((r"\b(?:pipe|piping)\b",), (r"\bvalves?\b",), (r"\bfittings?\b",)),
    "industrial_or_process_customer_focus": ((
        r"\b(?:serv(?:e|es|ing)|supply|supplies|sell(?:s|ing)|support(?:s|ing))\s+(?:industrial|process)\b",
        r"\b(?:industrial|process)\s+(?:customers|clients|markets|contractors|plants)\b",
    ),),
    "branch_count": ((r"\b(?:branch|location|facility)\b",),),
    "inside_sales_or_estimating_presence": ((r"\binside sales\b", r"\bestimat(?:ing|or|ors)\b"),),
    "rfq_or_quote_workflow_evidence": ((r"\b(?:rfq|request for quote|quotation|quote)\b",),),
    "project_or_tender_business": ((r"\b(?:projects?|tenders?|bids?)\b",),),
    "bom_or_line_item_complexity": ((r"\b(?:bom|bill of materials|line items?)\b",),),
    "manufacturer_count_or_breadth": ((r"\b(?:manufacturers?|line card|brands?)\b",),),
    "relevant_hiring": ((r"\b(?:hiring|careers?|open positions?|job openings?)\b",),),
    "employee_count": ((r"\b(?:employees?|staff|team members?)\b",),),
    "revenue_if_reliably_available": ((r"\b(?:revenue|sales|turnover)\b",),),
    "regional_independent_signal": ((r"\b(?:regional|independent|family-owned)\b",),),
    "multi_location_signal": ((r"\b(?:multi-location|multiple locations?|several locations?)\b",),),
    "known_current_direct_competitor_customer": ((r"\bcompetitor\b",), (r"\b(?:customer|client)\b",)),
    "known_competitor_evaluation_history": ((r"\bcompetitor\b",), (r"\b(?:evaluat(?:ed|ion)|assessment)\b",)),
    "known_quote_automation_or_order_automation_relationship": ((r"\b(?:quote|quotation|order)\b",), (r"\bautomation\b",)),
    "direct_quotation_pain_evidence": (
        (r"\b(?:quote|quotation|rfq|request for quote)\b",), (r"\b(?:pain|problem|delay|slow|manual|bottleneck|inefficien)\w*\b",),
    ),
    "manual_workflow_evidence": ((r"\b(?:manual workflow|manual process|spreadsheet(?:s)? for)\b",),),
    "explicit_process_bottleneck_evidence": ((r"\b(?:process|workflow)\b",), (r"\b(?:bottleneck|delay|slow|inefficien)\w*\b",)),
}
# Words of which one must stand in a clause, and none next to a denial.
TERMS: dict[str, tuple[str, ...]] = {
    "pvf_relevant": ("pvf", "pipe", "piping", "valve", "valves", "fitting", "fittings"),
    "pvf_product_breadth": ("pvf", "pipe", "piping", "valve", "valves", "fitting", "fittings", "product"),
    "industrial_or_process_customer_focus": ("industrial", "process", "plant", "contractor"),
    "branch_count": ("branch", "location", "facility"),
    "inside_sales_or_estimating_presence": ("inside sales", "estimating", "estimator"),
    "rfq_or_quote_workflow_evidence": ("rfq", "request for quote", "quotation", "quote"),
    "project_or_tender_business": ("project", "tender", "bid"),
    "bom_or_line_item_complexity": ("bom", "bill of materials", "line item"),
    "manufacturer_count_or_breadth": ("manufacturer", "line card", "brand"),
    "relevant_hiring": ("hiring", "career", "job", "position"),
    "employee_count": ("employee", "staff", "team"),
    "revenue_if_reliably_available": ("revenue", "sales", "turnover"),
    "regional_independent_signal": ("regional", "independent", "family-owned"),
    "multi_location_signal": ("location", "branch", "office"),
    "known_current_direct_competitor_customer": ("competitor", "customer", "client"),
    "known_competitor_evaluation_history": ("competitor", "evaluation", "evaluated"),
    "known_quote_automation_or_order_automation_relationship": ("automation", "quote", "order"),
    "direct_quotation_pain_evidence": ("quotation", "quote", "rfq"),
    "manual_workflow_evidence": ("manual", "spreadsheet", "workflow"),
    "explicit_process_bottleneck_evidence": ("bottleneck", "delay", "process"),
}
# What a value or a denial must be tied to.
CONCEPTS: dict[str, tuple[str, ...]] = {
    "pvf_relevant": ("pvf", "pipe", "piping", "valve", "valves", "fitting", "fittings"),
    "pvf_product_breadth": ("pvf", "pipe", "valve", "fitting", "product"),
    "industrial_or_process_customer_focus": ("industrial", "process", "customer", "facility"),
    "branch_count": ("branch", "branches", "location", "locations"),
    "inside_sales_or_estimating_presence": ("inside sales", "estimating", "estimator", "estimators"),
    "rfq_or_quote_workflow_evidence": ("rfq", "request for quote", "quote", "quotation"),
    "project_or_tender_business": ("project", "tender", "bid"),
    "bom_or_line_item_complexity": ("bom", "bill of materials", "line item", "line items"),
    "manufacturer_count_or_breadth": ("manufacturer", "manufacturers", "brand", "brands", "line card"),
    "relevant_hiring": ("hiring", "job", "jobs", "career", "careers"),
    "employee_count": ("employee", "employees", "staff", "headcount"),
    "revenue_if_reliably_available": ("revenue", "sales"),
    "regional_independent_signal": ("regional", "independent"),
    "multi_location_signal": ("location", "locations", "branch", "branches"),
    "known_current_direct_competitor_customer": ("competitor", "customer", "customers"),
    "known_competitor_evaluation_history": ("competitor", "evaluation", "evaluated", "pilot"),
    "known_quote_automation_or_order_automation_relationship": ("quote automation", "order automation", "automation"),
    "direct_quotation_pain_evidence": ("quote", "quotation", "rfq", "delay", "manual"),
    "manual_workflow_evidence": ("manual", "spreadsheet", "email", "workflow"),
    "explicit_process_bottleneck_evidence": ("bottleneck", "delay", "slow", "backlog", "process"),
}
# Verbs and nouns that say what a company does with a concept, where a fact needs one.
RELATIONS: dict[str, tuple[str, ...]] = {
    "pvf_relevant": (
        "sell", "sells", "selling", "sold", "distribute", "distributes", "distributed", "distribution", "distributor", "distributors", "offer", "offers",
        "offering", "provide", "provides", "providing", "supply", "supplies", "supplying", "carry", "carries", "stock", "stocks",
    ),
    "industrial_or_process_customer_focus": ("serve", "serves", "serving", "served"),
}
# Units that a number must stand before.
UNITS: dict[str, tuple[str, ...]] = {
    "branch_count": ("branch", "branches", "location", "locations", "facility", "facilities"),
    "employee_count": ("employee", "employees", "staff", "people", "team members"),
    "manufacturer_count_or_breadth": ("manufacturer", "manufacturers", "brand", "brands"),
}
# Words that deny what a clause says.
DENIAL = r"\b(?:no|not|none|never|without|does\s+not|doesn't|don't|isn't|aren't|lacks?|lacking)\b"
# What, right before a concept, denies it.
CONCEPT_DENIED = (
    r"(?:\bno\b|\bwithout\b|\bnot\b)\s+(?:(?:a|an|any|the|our|their|its)\s+)?$",
    r"(?:\b(?:do|does|did)\s+not|\b(?:don't|doesn't|didn't)|\bnever)\s+(?:have|offer|provide|employ|operate|run|use|maintain)\s+(?:(?:a|an|any|the|our|their|its)\s+)?$",
)
# What, up to three words before a concept, denies the verb between.
VERB_DENIED = r"(?:\b(?:do|does|did)\s+not|\b(?:don't|doesn't|didn't)|\bnever)\s+(?:[a-z][a-z'-]*\s+){1,3}$"
# What, right before a relation, denies it.
RELATION_DENIED = (
    r"(?:\b(?:do|does|did)\s+not|\b(?:don't|doesn't|didn't)|\bnever|\b(?:is|are|was|were)\s+not|\b(?:isn't|aren't|wasn't|weren't))\s+(?:(?:currently|actively|directly|typically|normally)\s+)?$",
    r"\b(?:is|are|was|were)\s+not\s+(?:(?:a|an|any|the|our|their|its)\s+)?(?:(?:industrial|process|pvf|carbon|stainless|steel)\s+)*$",
    r"(?:\bno\b|\bwithout\b)\s+$",
    r"(?:\b(?:do|does|did)\s+not|\b(?:don't|doesn't|didn't)|\bnever)\s+(?:manufactur(?:e|es|ing)|install(?:s|ing)?|fabricat(?:e|es|ing)|mak(?:e|es|ing)|produc(?:e|es|ing))"
    r"(?:\s+(?:a|an|any|the|industrial|process|pvf|carbon|stainless|steel|pipe|piping|valves?|fittings?)){0,4}\s+(?:or|nor)\s+$",
)
# What may stand between relations that share a denial, between a relation and its object, between a
# concept and its value.
COORDINATION = r"\s*(?:,\s*(?:(?:or|nor)\s+)?|(?:or|nor)\s+)"
OBJECT_BRIDGE = r"\s*(?:(?:a|an|any|the|industrial|process|pvf|carbon|stainless|steel)\s+)*(?:of\s+)?"
VALUE_BRIDGE = r"\s*(?:[,=/\-–—:]\s*|\b(?:count|number|total|value|level|breadth|of|is|are|was|were|equals?|include|includes|including|comprise|comprises|comprising)\b\s*)*"
# How revenue is stated.
REVENUE, CURRENCY = r"(?:revenue|sales|turnover)", r"(?:\$|usd\s*)?"
# Where one clause ends and the next begins.
CLAUSE_END = r"(?:[.!?;:\n]+|\b(?:and|but|however|whereas|while|yet)\b)"
