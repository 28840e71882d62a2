"""IP addresses: cleaning, validity, and order-preserving numbers."""

import ipaddress

from pyspark.sql import functions as F

from clickmart.functions.text import clean_text, first_filled, strip

_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
_V4 = rf"{_OCTET}(?:\.{_OCTET}){{3}}"
V4_TAIL = rf":({_V4})$"
_GROUP = "[0-9A-Fa-f]{1,4}"
V6_PATTERN = rf"^(?:{_GROUP}(?::{_GROUP})*)?(?:::(?:{_GROUP}(?::{_GROUP})*)?)?$"
V4_MAPPED = "0" * 20 + "ffff"

# Address blocks of the public registries that are not reachable from everywhere,
# and the blocks inside them that are.
V4_NOT_GLOBAL = """
    0.0.0.0/8 10.0.0.0/8 100.64.0.0/10 127.0.0.0/8 169.254.0.0/16 172.16.0.0/12 192.0.0.0/24
    192.0.0.170/31 192.0.2.0/24 192.168.0.0/16 198.18.0.0/15 198.51.100.0/24 203.0.113.0/24
    240.0.0.0/4 255.255.255.255/32
""".split()
V4_GLOBAL_AFTER_ALL = ["192.0.0.9/32", "192.0.0.10/32"]
V6_NOT_GLOBAL = """
    ::1/128 ::/128 64:ff9b:1::/48 100::/64 2001::/23 2001:db8::/32 2002::/16 fc00::/7 fe80::/10
""".split()
V6_GLOBAL_AFTER_ALL = """
    2001:1::1/128 2001:1::2/128 2001:3::/32 2001:4:112::/48 2001:20::/28 2001:30::/28
""".split()


def normalize_ip(column):
    """Cleaned text up to the first comma; may be empty when nothing stands before it."""
    return strip(F.split_part(clean_text(column), F.lit(","), F.lit(1)))


def distinct_key(column):
    """What makes two raw values the same visitor address."""
    return first_filled(normalize_ip(column), column)


def v4_number(parts):
    """BIGINT of a dotted address, given the array of its parts; null for everything else.

    A part counts when writing its number gives the same text: no signs, spaces or leading zeros.
    """
    number, valid = F.lit(0).cast("bigint"), F.size(parts) == 4
    for place in range(4):
        octet = F.get(parts, F.lit(place)).try_cast("int")
        number = number + octet * F.lit(256 ** (3 - place)).cast("bigint")
        valid = valid & octet.between(0, 255) & (octet.cast("string") == F.get(parts, F.lit(place)))
    return F.when(valid, number)


def octets(ip):
    return F.split(ip, "\\.")


def _expanded_v6(df, ip, name):
    """Adds column ``name``: 32 hex digits of an IPv6 address, which sort as text, or null.

    Done in steps, each a column of its own, so that no expression is repeated inside another.
    """
    colon = ip.contains(":") & (~ip.contains("%") | ip.rlike("^[^%]+%[^%]+$"))
    bare, tail, groups = F.col("_bare"), F.col("_tail"), F.col("_groups")
    head, rest = F.col("_head"), F.col("_rest")

    def side(place):
        text = F.split_part(groups, F.lit("::"), F.lit(place))
        return F.filter(F.split(text, ":"), lambda group: group != "")

    def digits(parts):
        return F.array_join(F.transform(parts, lambda group: F.lpad(group, 4, "0")), "")

    tail_groups = F.concat_ws(
        ":",
        F.hex(F.shiftright("_tail_number", 16)),
        F.hex(F.col("_tail_number").bitwiseAND(F.lit(65535).cast("bigint"))),
    )
    count = F.size(head) + F.size(rest)
    size_ok = F.when(groups.contains("::"), count <= 7).otherwise(count == 8)
    shape_ok = groups.rlike(V6_PATTERN)
    return (
        df.withColumn("_bare", F.when(colon, F.lower(F.split_part(ip, F.lit("%"), F.lit(1)))))
        .withColumn("_tail", F.regexp_extract(bare, V4_TAIL, 1))
        .withColumn("_tail_parts", octets(tail))
        .withColumn("_tail_number", v4_number(F.col("_tail_parts")))
        .withColumn(
            "_groups",
            F.when(tail == "", bare).otherwise(
                F.concat(F.left(bare, F.length(bare) - F.length(tail)), F.lower(tail_groups))
            ),
        )
        .withColumns({"_head": side(1), "_rest": side(2)})
        .withColumn(
            name,
            F.when(
                shape_ok & size_ok, F.concat(digits(head), F.repeat(F.lit("0000"), 8 - count), digits(rest))
            ),
        )
        .drop("_bare", "_tail", "_tail_parts", "_tail_number", "_groups", "_head", "_rest")
    )


def _inside(column, blocks, literal):
    """SQL condition that a column lies in one of the blocks."""
    ends = [(int(net.network_address), int(net.broadcast_address)) for net in map(ipaddress.ip_network, blocks)]
    return " OR ".join(f"{column} BETWEEN {literal(low)} AND {literal(high)}" for low, high in ends)


def _global_condition(column, blocks, exceptions, literal):
    return f"(NOT ({_inside(column, blocks, literal)}) OR ({_inside(column, exceptions, literal)}))"


def is_global_v4(column):
    """Condition on the name of a column of IPv4 numbers."""
    return _global_condition(column, V4_NOT_GLOBAL, V4_GLOBAL_AFTER_ALL, lambda number: f"{number}L")


def is_global_v6(column):
    """Condition on the name of a column of 32 hex digits."""
    return _global_condition(column, V6_NOT_GLOBAL, V6_GLOBAL_AFTER_ALL, lambda number: f"'{number:032x}'")


def with_address(df, column):
    """Adds the normalised text ``address``, and its number: ``v4`` as BIGINT or ``v6`` as hex digits."""
    numbered = (
        df.withColumn("address", normalize_ip(F.col(column)))
        .withColumn("_parts", octets(F.col("address")))
        .withColumn("v4", v4_number(F.col("_parts")))
        .drop("_parts")
    )
    # A filter on the results would be moved below all steps and repeat them inside one another. A
    # column that is no function of the row keeps it above.
    lined = _expanded_v6(numbered, F.col("address"), "v6").withColumn("_line", F.monotonically_increasing_id())
    seen = F.col("_line") >= 0
    return lined.withColumns(
        {"v4": F.when(seen, F.col("v4")), "v6": F.when(seen, F.col("v6")), "address": F.when(seen, F.col("address"))}
    ).drop("_line")


def mapped_v4(v6):
    """The IPv4 number that 32 hex digits map, null for other addresses."""
    return F.when(F.left(v6, F.lit(24)) == V4_MAPPED, F.conv(F.substring(v6, 25, 8), 16, 10).try_cast("bigint"))


def with_validity(df, column, allow_private=False, name="valid"):
    """``with_address`` and whether the address is well-formed and reachable from everywhere."""
    known = with_address(df, column)
    v4, v6 = F.col("v4"), F.col("v6")
    if allow_private:
        return known.withColumn(name, v4.isNotNull() | v6.isNotNull())
    mapped = mapped_v4(v6)
    valid = F.expr(
        f"CASE WHEN v4 IS NOT NULL THEN {is_global_v4('v4')} WHEN _mapped IS NOT NULL THEN "
        f"{is_global_v4('_mapped')} WHEN v6 IS NOT NULL THEN {is_global_v6('v6')} ELSE false END"
    )
    return known.withColumn("_mapped", mapped).withColumn(name, valid).drop("_mapped")


def clean_geo_text(column):
    """Null for blank text and for the marks geo tables use for unknown values."""
    text = strip(column.cast("string"))
    unknown = text.isin("", "-") | text.contains("unavailable in selected .BIN")
    return F.when(~unknown, text)


def clean_geo_number(column):
    return column.try_cast("double")


def location_key(country, region, city, latitude, longitude):
    """``country | region | city``, or the coordinates where all three are blank."""
    names = [F.coalesce(strip(part), F.lit("")) for part in (country, region, city)]
    joined = F.concat_ws(" | ", *names)
    no_names = F.concat(*names) == ""
    return F.when(no_names, F.concat(latitude.cast("string"), F.lit(","), longitude.cast("string"))).otherwise(
        joined
    )
