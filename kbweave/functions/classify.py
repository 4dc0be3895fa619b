"""Rule-based classifiers as CASE chains: the first rule that holds decides."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kbweave.functions.markers import MANY, first_rule_of_many
from kbweave.functions.text import empty_if_null
from kbweave.functions.urls import any_contains

#: Keywords of reward categories, in order of precedence.
REWARD_CATEGORIES = (
    ("Electronics", ("headphone", "speaker", "earphone", "camera", "laptop", "phone", "mobile", "tv", "tablet")),
    ("Travel & Holiday", ("hotel", "flight", "holiday", "travel", "airport", "cleartrip", "makemytrip", "yatra")),
    ("e-Voucher", ("voucher", "e-voucher", "gift card", "egift", "digital code")),
    ("Health & Fitness", ("health", "fitness", "gym", "pharma", "wellness", "spa", "yoga", "protein")),
    ("Entertainment & Dining", ("movie", "dining", "restaurant", "ott", "streaming", "pvr", "bookmyshow", "zomato", "swiggy")),
    ("Lifestyle", ("lifestyle", "watch", "sunglasses", "perfume", "grooming", "cologne")),
    ("Apparel & Superstore", ("apparel", "clothing", "shoes", "fashion", "sneaker", "denim", "shirt", "saree")),
    ("Accessories", ("bag", "luggage", "wallet", "handbag", "backpack", "suitcase", "belt")),
    ("Homeware", ("home", "kitchen", "cookware", "appliance", "furniture", "bedding", "mattress")),
    ("Kids Zone", ("kids", "toy", "children", "baby", "game", "puzzle")),
    ("Luxury", ("luxury", "premium", "designer", "gold", "diamond", "platinum")),
    ("Memberships", ("membership", "subscription", "club", "prime", "pass", "annual")),
    ("Books & Periodicals", ("book", "novel", "magazine", "periodical", "kindle", "ebook")),
)
#: Signs of redemption types, in order of precedence.
REDEMPTION_TYPES = (
    ("e_voucher", ("voucher", "e-voucher", "gift card", "egift", "digital code")),
    ("membership", ("membership", "subscription", "club", "prime")),
    ("airmile", ("airmile", "air mile", "air india", "indigo", "vistara")),
    ("travel", ("hotel", "holiday", "flight", "travel")),
)
#: Signs of offer types, in order of precedence.
OFFER_TYPES = (
    ("no_cost_emi", ("no cost emi",)),
    ("emi", ("emi",)),
    ("cashback", ("cashback",)),
    ("discount", ("discount", " off")),
    ("reward_points", ("reward",)),
    ("voucher", ("voucher", "gift card")),
    ("free_benefit", ("free",)),
    ("travel", ("travel", "airport")),
    ("dining", ("dining", "restaurant")),
)
#: Failure buckets of error texts, in order of precedence.
FAILURE_BUCKETS = (
    ("antibot", ("anti-bot", "antibot")),
    ("timeout", ("timeout", "timed out")),
    ("empty_response", ("err_empty_response", "empty response")),
    ("navigation", ("failed on navigating", "acs-goto")),
)


def first_rule(text: Column, rules: tuple[tuple[str, tuple[str, ...]], ...], default: str) -> Column:
    """The name of the first rule one of whose markers the lower-cased text contains; rules of very many markers read the text once."""
    if sum(len(markers) for _, markers in rules) >= MANY:
        return first_rule_of_many(text, rules, default)
    low = F.lower(empty_if_null(text))
    out = F.when(F.lit(False), F.lit(default))
    for name, markers in rules:
        out = out.when(any_contains(low, markers), name)
    return out.otherwise(default)


def offer_type(signals: Column) -> Column:
    return first_rule(signals, OFFER_TYPES, "general")


def reward_category(description_and_features: Column) -> Column:
    return first_rule(description_and_features, REWARD_CATEGORIES, "General")


def redemption_type(name_category_description: Column) -> Column:
    return first_rule(name_category_description, REDEMPTION_TYPES, "physical_product")


def failure_bucket(error: Column) -> Column:
    return first_rule(error, FAILURE_BUCKETS, "other")


#: The place of a page in the site's menu, in order of precedence. A rule holds if one of its conditions does; a condition is a list of tests that must all hold, each
#: (field, test, value) over the path, title or body in lower case, with a leading "!" where it must not hold.
CORPORATE = ((("path", "has", "/corporate/"),), (("title", "starts", "corporate"),))
MENU = (
    ("Personal", "help", ((("title", "has", "404 page not found"),), (("body", "has", "page requested by you does not exist"),))),
    ("Corporate", "offers", tuple((*c, t) for c in CORPORATE for t in (("path", "has", "offers"), ("title", "has", "offer")))),
    ("Corporate", "customized-solutions", tuple((*c, t) for c in CORPORATE for t in (("path", "has", "customized-solutions"), ("title", "has", "customized solution")))),
    ("Corporate", "credit-cards", CORPORATE),
    ("Personal", "terms-condition", ((("path", "starts", "/en/tnc.page"),), (("path", "has", "most-important-terms-and-conditions"),))),
    ("Personal", "help", ((("path", "starts", "/en/help.page"),), (("path", "starts", "/en/faq/"),), (("path", "is", "/en/faq.page"),))),
    ("Personal", "offers", ((("path", "starts", "/en/personal/offers.page"),), (("path", "has", "/offers/"),))),
    ("Personal", "pay", ((("path", "starts", "/en/personal/benefits/lower-interest-option/"),),)),
    ("Personal", "benefits", ((("path", "starts", "/en/personal/benefits/"),),)),
    ("Personal", "help", ((("path", "starts", "/en/eapply/track-credit-card-application.page"),),)),
    ("Personal", "credit-cards", ((("path", "starts", "/en/eapply/"),), (("path", "starts", "/sprint/"),))),
    ("Personal", "help", ((("path", "starts", "/creditcards/app/"),),)),
    ("Personal", "rewards", tuple((t, ("path", "!starts", "/en/personal/credit-cards/")) for t in (("path", "starts", "/en/personal/rewards"), ("path", "has", "/reward")))),
    ("Personal", "credit-cards", ((("path", "starts", "/en/personal/credit-cards"),), (("path", "has", "/personal/credit-cards/"),))),
)


def menu_taxonomy(path: Column, title: Column, body: Column) -> Column:
    """struct<category, sub_category> of a page by the first rule of MENU that holds; help of the personal menu if none does."""
    fields = {"path": F.lower(F.coalesce(F.nullif(path, F.lit("")), F.lit("/"))), "title": F.lower(empty_if_null(title)), "body": F.lower(empty_if_null(body))}
    tests = {"has": F.contains, "starts": F.startswith, "is": lambda x, v: x == v}

    def holds(field: str, test: str, value: str) -> Column:
        found = tests[test.lstrip("!")](fields[field], F.lit(value))
        return ~found if test.startswith("!") else found

    out = F.when(F.lit(False), F.lit(None).cast("struct<category:string,sub_category:string>"))
    for category, sub, conditions in MENU:
        out = out.when(_any([_all([holds(*t) for t in c]) for c in conditions]), F.struct(F.lit(category).alias("category"), F.lit(sub).alias("sub_category")))
    return out.otherwise(F.struct(F.lit("Personal").alias("category"), F.lit("help").alias("sub_category")))


def _all(tests: list[Column]) -> Column:
    out = tests[0]
    for t in tests[1:]:
        out = out & t
    return out


def _any(tests: list[Column]) -> Column:
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return out


def tags(**conditions: Column) -> Column:
    """Sorted names of the conditions that hold; a string column stands for its own value."""
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in conditions.items()]))))


def offer_tags(primary: Column, sub: Column, kind: Column, promo: Column, has_table: Column, start: Column, has_cards: Column) -> Column:
    named = [F.nullif(empty_if_null(c), F.lit("")) for c in (primary, sub, kind)]
    flags = [F.when(empty_if_null(promo) != "", "has_promo_code"), F.when(has_table, "has_table"), F.when(start.isNotNull(), "has_validity"), F.when(has_cards, "has_eligible_cards")]
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*named, *flags))))


def reward_tags(category: Column, redemption: Column, points_pay: Column, has_features: Column, has_description: Column, cities: Column) -> Column:
    slug = F.nullif(F.replace(F.replace(F.replace(F.lower(empty_if_null(category)), F.lit(" "), F.lit("_")), F.lit("&"), F.lit("and")), F.lit("/"), F.lit("_")), F.lit(""))
    flags = [F.when(F.coalesce(points_pay, F.lit(0)) != 0, "has_points_pay_option"), F.when(has_features, "has_features"), F.when(has_description, "has_description"), F.when(F.coalesce(cities, F.lit(0)) > 0, "city_restricted").otherwise("pan_india")]
    return F.array_sort(F.array_distinct(F.array_compact(F.array(slug, F.nullif(empty_if_null(redemption), F.lit("")), *flags))))
