"""Address classification."""

from pyspark.sql import Column, functions as F

from netbaseline.functions.text import _c

# Private IPv4 ranges (flag 0 = internal, 1 = external).
#   10.0.0.0/8, 172.16.0.0/12, 192.168.0.0/16


def internal_flag(ip, parity: bool = False) -> Column:
    """0 for a private IPv4 address, 1 for any other, NULL if not dotted IPv4.

    With ``parity=True`` an address ``172.x.y.z`` outside 172.16/12 is still
    internal when ``x`` is 168, as the reference's range test lets it through.
    """
    s = F.trim(_c(ip).cast("string"))
    valid = s.rlike(r"^(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(\.(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])){3}$")
    parts = F.split(s, r"\.")
    a = parts.getItem(0).cast("int")
    b = parts.getItem(1).cast("int")
    private = (a == 10) | ((a == 172) & b.between(16, 31)) | ((a == 192) & (b == 168))
    if parity:
        private = private | ((a == 172) & (b == 168))
    return F.when(~valid | s.isNull(), F.lit(None).cast("int")) \
        .when(private, F.lit(0)).otherwise(F.lit(1))
