"""Secondary sources: offer and reward documents from listing and detail records, people with their bios, and their page form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kbweave.functions import classify
from kbweave.functions.text import collapse, empty_if_null, first_word_brand, let, section_chunk
from kbweave.functions.urls import any_contains, domain, path

#: Navigation labels and fragments that are no content. Names of a site's own products are added by the caller.
NOISE_EXACT = (
    "login", "apply now", "contact us", "faq", "personal", "corporate", "credit cards", "card payment", "redeem rewards", "benefits", "deals & offers", "help me find a card", "compare cards",
    "track my application", "secure your card", "tokenisation", "link pan with aadhaar", "link pan with adhaar", "terms & conditions", "order of payment settlement", "customer notices", "posh policy",
    "forms central", "offers terms & conditions", "cardholder agreement", "customer grievance redressal policy", "fair practice code", "procurement news", "odr portal link & circular for shareholders",
    "credit card inssuarance & conduct policy", "balance transfer", "spend analyzer", "statement", "bill pay & recharge", "check reward points", "earn reward points", "redeem reward points", "view catalogue",
    "address change kyc", "download forms", "raise a dispute", "request for card closure", "customer care", "report lost card", "digital platform updates", "digital membership kits", "go digital",
    "card security tips", "paynet - pay online", "top & recharge", "paynet- online payment", "standing instruction", "electronic bill payment", "mobile app", "upi & qr codes", "debit card",
    "over the counter", "cheque - manual drop box", "view all payment modes", "all offers", "offers this week", "convert to emi", "mobile icon", "back to offers list", "offer details",
    "terms and conditions", "avail now", "download mobile app", "all", "dept stores & grocery", "dining", "education", "electronics & mobiles", "entertainment", "fashion & lifestyle", "health & fitness",
    "hill station offers", "jewellery", "mall offers", "my city offers", "network offers", "online marketplace", "travel & lodging", "utilities and services", "hello!", "interactive assistant", "confirm exit",
    "chat history", "app store", "play store", "get it on google play", "download on the app store", "send link to your phone", "know more", "explore", "services", "important links", "home", "offers", "offer-detail",
)
NOISE_PARTS = ("© 20", "click here for merchant emi", "app solutely simple", "appstore", "playstore", "google play", "send link to your phone", "download mobile app", "all dept stores", "dept stores & grocery dining")
#: How the names of people start, and images that show none.
PERSON_PREFIX = r"^(?i:Mr\.|Ms\.|Mrs\.|Smt\.|CA\s|Dr\.)"
PLACEHOLDERS = ("placeholder", "app-", "solutely", "appstore", "playstore")


def is_noise(x: Column, exact: tuple[str, ...] = NOISE_EXACT, parts: tuple[str, ...] = NOISE_PARTS) -> Column:
    low = F.lower(F.trim(empty_if_null(x)))
    return (F.length(low) < 3) | low.isin(*exact) | any_contains(low, parts)


def is_person(name: Column, image: Column) -> Column:
    """Whether an image's text names a person and the image is not a placeholder."""
    return empty_if_null(name).rlike(PERSON_PREFIX) & ~any_contains(F.lower(empty_if_null(image)), PLACEHOLDERS)


def prefer(first: Column, second: Column) -> Column:
    """The first value unless it is NULL or empty."""
    return F.coalesce(F.nullif(first, F.lit("")), second)


def filled(x: Column) -> Column:
    return F.coalesce(x, F.array().cast("array<string>"))


def offer_documents(cards: DataFrame, details: DataFrame) -> DataFrame:
    """cards(offer_url, brand_name, hover_text, discount_text, primary_category, sub_category) with details(offer_url, offer_title,
    offer_description, discount_text, promo_code, offer_start_date, summary_text, eligible_cards, steps_to_avail, terms_and_conditions, summary_table);
    fields of the detail page come first, offers without one stay."""
    c, d = cards.alias("c"), details.alias("d")
    lists = {n: filled(F.col(f"d.{n}")) for n in ("summary_text", "eligible_cards", "steps_to_avail", "terms_and_conditions")}
    table = F.coalesce(F.col("d.summary_table"), F.array().cast("array<map<string,string>>"))
    signals = F.concat_ws(" ", F.array_join(lists["summary_text"], " "), F.to_json(table), F.array_join(lists["steps_to_avail"], " "))
    kind = classify.offer_type(signals)
    title = prefer(F.col("d.offer_title"), empty_if_null(F.col("c.hover_text")))
    full = [F.col("d.offer_title"), F.col("d.offer_description"), *[F.array_join(lists[n], " ") for n in ("eligible_cards", "summary_text", "steps_to_avail")], F.col("d.discount_text"), F.col("c.hover_text")]
    joined = c.join(d, F.col("c.offer_url") == F.col("d.offer_url"), "left")
    return joined.select(
        F.col("c.offer_url").alias("source_url"),
        F.substring(F.md5("c.offer_url"), 1, 12).alias("offer_id"),
        title.alias("offer_title"),
        F.concat_ws(" | ", *[F.nullif(empty_if_null(x), F.lit("")) for x in full]).alias("offer_text"),
        prefer(F.col("d.discount_text"), F.nullif(F.col("c.discount_text"), F.lit(""))).alias("discount_text"),
        F.col("d.promo_code").alias("promo_code"),
        kind.alias("offer_type"),
        empty_if_null(F.col("c.brand_name")).alias("brand_name"),
        lists["summary_text"].alias("summary_text"),
        table.alias("summary_table"),
        classify.offer_tags(F.col("c.primary_category"), F.col("c.sub_category"), kind, F.col("d.promo_code"), F.size(table) > 0, F.col("d.offer_start_date"), F.size(lists["eligible_cards"]) > 0).alias("tags"),
        *[section_chunk(n, lists[k]).alias(f"chunk_{a}") for a, n, k in (("summary", "summary", "summary_text"), ("eligible_cards", "eligible_cards", "eligible_cards"), ("steps", "steps_to_avail", "steps_to_avail"), ("terms", "terms", "terms_and_conditions"))],
    )


def reward_documents(listing: DataFrame, details: DataFrame) -> DataFrame:
    """listing(item_id, detail_url, product_name, points_only, category, brand_name) with details(detail_url, product_name, points_only,
    points_pay_points, points_pay_cash, product_description, features, available_cities, terms_and_conditions), cheapest first."""
    a, d = listing.alias("a"), details.alias("d")
    features, cities, terms = (filled(F.col(f"d.{n}")) for n in ("features", "available_cities", "terms_and_conditions"))
    name = prefer(F.col("d.product_name"), empty_if_null(F.col("a.product_name")))
    description = empty_if_null(F.col("d.product_description"))
    category = prefer(F.col("a.category"), classify.reward_category(F.concat_ws(" ", description, F.array_join(features, " "))))
    brand = prefer(F.col("a.brand_name"), first_word_brand(name))
    kind = classify.redemption_type(F.concat_ws(" ", name, category, description))
    texts = [name, description, F.array_join(features, " "), category, brand]
    joined = a.join(d, F.col("a.detail_url") == F.col("d.detail_url"), "left")
    return joined.select(
        F.col("a.item_id").alias("item_id"),
        F.col("a.detail_url").alias("source_url"),
        name.alias("product_name"),
        F.concat_ws(" | ", *[F.nullif(t, F.lit("")) for t in texts]).alias("reward_text"),
        brand.alias("brand_name"),
        category.alias("category"),
        kind.alias("redemption_type"),
        F.coalesce(F.nullif(F.col("d.points_only"), F.lit(0)), "a.points_only").alias("points_only"),
        F.col("d.points_pay_points").alias("points_pay_points"),
        F.col("d.points_pay_cash").alias("points_pay_cash"),
        F.nullif(description, F.lit("")).alias("product_description"),
        cities.alias("available_cities"),
        (F.size(cities) == 0).alias("is_pan_india"),
        classify.reward_tags(F.col("a.category"), kind, F.col("d.points_pay_points"), F.size(features) > 0, description != "", F.size(cities)).alias("tags"),
        section_chunk("description", F.array(description)).alias("chunk_description"),
        section_chunk("features", features).alias("chunk_features"),
        section_chunk("terms", terms).alias("chunk_terms"),
    ).orderBy(F.coalesce("points_only", F.lit(0)))


def _page(title: Column, description: Column, keywords: Column, category: str, sub: Column, markdown: Column) -> list[Column]:
    url = F.trim(F.col("source_url"))
    return [
        title.alias("title"), description.alias("description"), keywords.alias("keywords"), F.lit(category).alias("category"), sub.alias("sub_category"),
        url.alias("source_url"), F.coalesce(F.nullif(path(url, params=False), F.lit("")), F.lit("/")).alias("path"), domain(url).alias("domain"),
        F.lit(0).alias("depth"), F.lit(True).alias("success"), F.lit(200).alias("status_code"), F.lit("").alias("error"), markdown.alias("markdown"),
    ]


def offer_pages(offers: DataFrame, untitled: str = "Offer") -> DataFrame:
    """Offers as crawled pages: brand and the first six summary lines as title, all lines and the table as body."""
    bits = F.filter(F.transform("summary_text", lambda s: F.trim(s)), lambda s: s != "")
    head = F.concat_ws(" | ", F.nullif(F.trim(empty_if_null(F.col("brand_name"))), F.lit("")), F.nullif(F.array_join(F.slice(bits, 1, 6), " | "), F.lit("")))
    body = F.concat_ws("\n", F.nullif(F.array_join(bits, " | "), F.lit("")), F.when(F.size("summary_table") > 0, F.to_json("summary_table")))
    keywords = F.array_join(F.filter("tags", lambda t: F.trim(t) != ""), ",")
    return offers.where(F.trim(empty_if_null(F.col("source_url"))) != "").select(*_page(prefer(head, F.lit(untitled)), body, keywords, "Offers", F.lit(None).cast("string"), body))


def reward_pages(rewards: DataFrame, untitled: str = "Reward") -> DataFrame:
    """Rewards as crawled pages whose body lists points, category, brand, cities, features and terms where they are known."""
    t = lambda n: F.trim(empty_if_null(F.col(n)))
    name = prefer(t("product_name"), F.lit(untitled))
    title = let(name, lambda n: F.when((t("reward_text") != "") & (t("reward_text") != n) & ~F.startswith(t("reward_text"), F.concat(n, F.lit(" |"))), F.concat(n, F.lit(" | "), t("reward_text"))).otherwise(n))
    description = prefer(t("product_description"), F.trim(F.regexp_replace(t("chunk_description"), "^\\[description\\]\\s*", "")))
    cities = filled(F.col("available_cities"))
    line = lambda label, value, ok: F.when(ok, F.concat(F.lit(f"- {label}: "), value))
    lines = [
        F.nullif(description, F.lit("")),
        F.lit(""),
        F.lit("## Reward details"),
        line("Points only", F.col("points_only").cast("string"), F.col("points_only").isNotNull()),
        line("Points + Pay", F.concat(F.col("points_pay_points").cast("string"), F.lit(" + ₹"), F.coalesce("points_pay_cash", F.lit(0)).cast("string")), F.col("points_pay_points").isNotNull()),
        *[line(label, t(n), t(n) != "") for label, n in (("Category", "category"), ("Redemption type", "redemption_type"), ("Brand", "brand_name"))],
        line("City restriction", F.concat(F.size(cities).cast("string"), F.lit(" cities")), F.size(cities) > 0),
        line("Cities (preview)", F.array_join(F.slice(cities, 1, 20), ", "), F.size(cities) > 0),
        *[F.when(t(n) != "", F.concat(F.lit(f"\n## {head}\n"), t(n))) for head, n in (("Features", "chunk_features"), ("Terms & conditions", "chunk_terms"))],
    ]
    body = F.trim(F.regexp_replace(F.concat_ws("\n", *lines), "^\\s+", ""))
    keywords = F.array_join(F.filter("tags", lambda x: F.trim(x) != ""), ",")
    return rewards.where(t("source_url") != "").select(*_page(title, description, keywords, "Rewards", F.nullif(t("category"), F.lit("")), body))


def match_bios(people: DataFrame, bios: DataFrame) -> DataFrame:
    """people(name, alt_name) with bios(bio_name, bio, ord): by display name, else by alternative name, else the first bio with the same last word."""
    last = lambda x: F.lower(F.element_at(F.split(collapse(x), " "), -1))
    named = bios.groupBy("bio_name").agg(F.min_by("bio", "ord").alias("bio"))
    by_last = bios.groupBy(last(F.col("bio_name")).alias("last")).agg(F.min_by("bio", "ord").alias("bio_last"))
    out = people.join(named.toDF("name", "bio_exact"), "name", "left").join(named.toDF("alt_name", "bio_alt"), "alt_name", "left").withColumn("last", last(F.col("name"))).join(by_last, "last", "left")
    return out.select(*people.columns, F.coalesce("bio_exact", "bio_alt", "bio_last", F.lit("")).alias("bio"))


def structured_page(title: str, payload: Column, url: str, description: Column, keywords: str) -> list[Column]:
    """A page whose body carries a structure as fenced JSON."""
    body = F.concat(F.lit(f"# {title}\n\nStructured payload (machine-readable JSON):\n\n```json\n"), F.to_json(payload), F.lit("\n```\n"))
    return [F.lit(title).alias("title"), description.alias("description"), F.lit(keywords).alias("keywords"), F.lit(url).alias("source_url"), F.lit(True).alias("success"), F.lit(200).alias("status_code"), body.alias("markdown")]
