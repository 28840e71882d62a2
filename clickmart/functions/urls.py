"""Store URLs and the list of URLs to try for a product."""

from dataclasses import dataclass, field

from pyspark.sql import functions as F

from clickmart.functions.text import blank_to_null

HOST = r"^[\x00-\x20]*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)"

# Store suffixes in the order they are tried. The first five are English stores.
STORE_SUFFIXES = ("com.au", "com", "co.uk", "ca", "ie", "de", "fr", "it", "pl", "vn")
ENGLISH_STORE_COUNT = 5

# Names of the ways a URL was chosen.
ORIGINAL_URL = "original_url"
SOURCE_DOMAIN_URL = "source_domain_product_id_url"
FALLBACK_DOMAIN_URL = "fallback_domain_product_id_url"


@dataclass(frozen=True)
class Stores:
    """The shop brand and its web domains."""

    brand: str
    fallback_domains: tuple = field(default=())
    english_domains: tuple = field(default=())

    @classmethod
    def of_brand(cls, brand, fallback_domains=None):
        domains = tuple(f"www.{brand}.{suffix}" for suffix in STORE_SUFFIXES)
        return cls(brand, tuple(fallback_domains or domains), domains[:ENGLISH_STORE_COUNT])


def url_host(url):
    """Lower-case host part with port and user, empty where the URL has none."""
    return F.lower(F.regexp_extract(F.translate(url, "\t\r\n", ""), HOST, 1))


def is_broken_host(host):
    """A host with only one of the two IPv6 brackets cannot be read as a URL."""
    return host.contains("[") != host.contains("]")


def country_store(url, stores):
    """The part of the host after the brand name, or the whole host of another shop."""
    brand_prefix = rf"^(?:www\.)?{stores.brand.replace('.', chr(92) + '.')}\."
    return blank_to_null(F.regexp_replace(url_host(url), brand_prefix, ""))


def catalog_url(domain, product_id):
    return F.concat(F.lit("https://"), domain, F.lit("/catalog/product/view/id/"), product_id)


def _attempt(url, strategy, when):
    return F.struct(F.when(when, url).alias("url"), F.lit(strategy).alias("strategy"))


def url_choices(product_id, source_url, host, stores):
    """Array of (url, strategy) in the order to try. A URL may occur twice or be null.

    At most the number of fallback domains + 3 entries, so it never grows with the data.
    """
    english = host.isin(*stores.english_domains) if stores.english_domains else F.lit(False)
    own_url = catalog_url(host, product_id)
    return F.array(
        _attempt(source_url, ORIGINAL_URL, F.lit(True)),
        _attempt(own_url, SOURCE_DOMAIN_URL, english),
        *[
            _attempt(catalog_url(F.lit(domain), product_id), FALLBACK_DOMAIN_URL, F.lit(True))
            for domain in stores.fallback_domains
        ],
        _attempt(own_url, SOURCE_DOMAIN_URL, (host != "") & ~english),
    )


def first_of_each_url(choices):
    """The entries with a URL, each URL once, first one kept. Give it a column, not an expression."""
    urls = F.transform(choices, lambda choice: choice["url"])
    return F.filter(
        choices,
        lambda choice, place: (choice["url"] != "")
        & (F.array_position(urls, choice["url"]) == place + 1),
    )
