from sparsepages.functions.decode import filled_record
from sparsepages.functions.routes import DEFAULT_ROUTES, Route, route_match, url_path
from sparsepages.functions.validation import Rule, length_rule, password_rules, range_rule, rule_passes

__all__ = [
    "DEFAULT_ROUTES",
    "Route",
    "Rule",
    "filled_record",
    "length_rule",
    "password_rules",
    "range_rule",
    "route_match",
    "rule_passes",
    "url_path",
]
