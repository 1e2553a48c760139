"""Address order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

IPV4 = r"^\d{1,3}(\.\d{1,3}){3}$"


def ipv4_key(address: Column) -> Column:
    """The four octets as an array, which Spark orders element by element; null for
    anything that is not a dotted quad."""
    octets = F.transform(F.split(address, r"\."), lambda o: o.try_cast("int"))
    return F.when(address.rlike(IPV4), octets)


def precedes(a: Column, b: Column) -> Column:
    """Numeric order between two IPv4 addresses, string order otherwise."""
    return F.coalesce(ipv4_key(a) < ipv4_key(b), a < b)
