"""Great-circle geometry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# IUGG mean radius
EARTH_RADIUS_KM = 6371.0088


def _double(value: Column) -> Column:
    return value.cast("double")


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    phi1, phi2 = F.radians(_double(lat1)), F.radians(_double(lat2))
    half_phi = F.sin((phi2 - phi1) / 2)
    half_lambda = F.sin((F.radians(_double(lon2)) - F.radians(_double(lon1))) / 2)
    h = half_phi * half_phi + F.cos(phi1) * F.cos(phi2) * half_lambda * half_lambda
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def unit_sphere(lat: Column, lon: Column) -> tuple[Column, Column, Column]:
    """Point on the unit sphere; straight-line distance there orders pairs as
    great-circle distance does, with no seam at the date line or the poles."""
    phi, lam = F.radians(_double(lat)), F.radians(_double(lon))
    return F.cos(phi) * F.cos(lam), F.cos(phi) * F.sin(lam), F.sin(phi)
