"""Parcels, bounds, vectors and pixels, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PARCEL = 16
MARGIN = 0.05
FAR = 10_000.0
PIXEL_TOLERANCE = 9
MAX_SIDE = 1024


def parcel(pointer: Column) -> Column:
    """'x,y' as integers; an error if malformed."""
    part = F.split(pointer, ",")
    return F.struct(part[0].cast("int").alias("x"), part[1].cast("int").alias("y"))


def corner(x: Column) -> Column:
    return x * PARCEL


def scene_plane(x: Column, y: Column) -> list[Column]:
    """Aggregates: the rectangle around a scene's parcels, with a margin."""
    return [
        (F.min(x * PARCEL) - MARGIN).alias("min_x"),
        (F.max(x * PARCEL + PARCEL) + MARGIN).alias("max_x"),
        (F.min(y * PARCEL) - MARGIN).alias("min_z"),
        (F.max(y * PARCEL + PARCEL) + MARGIN).alias("max_z"),
    ]


def scene_height(parcels: Column) -> Column:
    return F.log2(parcels + 1.0) * 20


def scene_box(min_x: Column, max_x: Column, min_z: Column, max_z: Column, height: Column, lod: Column) -> Column:
    pad = F.when(lod == 0, 0.5).otherwise(2.0)
    return F.struct(
        F.struct(((min_x + max_x) / 2).alias("x"), (height / 2).alias("y"), ((min_z + max_z) / 2).alias("z")).alias("center"),
        F.struct((max_x - min_x + pad).alias("x"), (height * 2).alias("y"), (max_z - min_z + pad).alias("z")).alias("size"),
    )


def contains_corners(corners: Column, center: Column, size: Column) -> Column:
    """All corners (structs x, y, z) of a mesh lie in the box."""
    inside = lambda c, k: F.abs(c[k] - center[k]) <= size[k] / 2
    return F.forall(corners, lambda c: inside(c, "x") & inside(c, "y") & inside(c, "z"))


def safe_bounds(x: Column, y: Column, z: Column) -> Column:
    """Bounds far from the origin collapse to it."""
    far = x * x + y * y + z * z > FAR * FAR
    zero = F.lit(0.0)
    return F.struct(*[F.when(far, zero).otherwise(c).alias(n) for n, c in zip("xyz", (x, y, z))])


def rotate(q: Column, v: Column) -> Column:
    """Vector ``v`` turned by the unit quaternion ``q``."""
    cross = lambda a, b: (a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0])
    u, w, x = (q["x"], q["y"], q["z"]), q["w"], (v["x"], v["y"], v["z"])
    t = [2 * c for c in cross(u, x)]
    return F.struct(*[(a + w * b + c).alias(n) for n, a, b, c in zip("xyz", x, t, cross(u, t))])


def compose_rotation(a: Column, b: Column) -> Column:
    ax, ay, az, aw = (a[k] for k in "xyzw")
    bx, by, bz, bw = (b[k] for k in "xyzw")
    return F.struct(
        (aw * bx + ax * bw + ay * bz - az * by).alias("x"),
        (aw * by - ax * bz + ay * bw + az * bx).alias("y"),
        (aw * bz + ax * by - ay * bx + az * bw).alias("z"),
        (aw * bw - ax * bx - ay * by - az * bz).alias("w"),
    )


def place(position: Column, rotation: Column, scale: Column, child_position: Column, child_rotation: Column, child_scale: Column) -> Column:
    """A child's transform under a parent's: position + rotation * child, rotations composed, scales multiplied."""
    turned = rotate(rotation, child_position)
    return F.struct(
        F.struct(*[(position[k] + turned[k]).alias(k) for k in "xyz"]).alias("position"),
        compose_rotation(rotation, child_rotation).alias("rotation"),
        F.struct(*[(scale[k] * child_scale[k]).alias(k) for k in "xyz"]).alias("scale"),
    )


def same_pixel(a: Column, b: Column) -> Column:
    """Channels differ by less than the tolerance; alpha doesn't count."""
    return (F.abs(a["r"] - b["r"]) < PIXEL_TOLERANCE) & (F.abs(a["g"] - b["g"]) < PIXEL_TOLERANCE) & (F.abs(a["b"] - b["b"]) < PIXEL_TOLERANCE)


def affinity(total: Column, differing: Column) -> Column:
    """Percent of equal pixels, rounded down."""
    return F.floor((total - differing) * 100 / total).cast("long")


def scaled_side(side: Column, width: Column, height: Column, most: int = MAX_SIDE) -> Column:
    """A side after shrinking the longer one to ``most``, truncated."""
    longest = F.greatest(width, height)
    return F.when(longest <= most, side).otherwise((side * (F.lit(float(most)) / longest)).cast("int"))


def parcel_offset(x: Column, y: Column, side: int = 16) -> Column:
    """Where the base parcel lies: (16 x, 0, 16 y)."""
    return F.struct((x * side).alias("x"), F.lit(0).alias("y"), (y * side).alias("z"))


def merged_bounds(least: Column, most: Column) -> Column:
    """Aggregate: the smallest box around all boxes (structs x, y, z of their corners); null boxes don't count."""
    ends = [f(c[a]).alias(f"{n}_{a}") for n, f, c in (("min", F.min, least), ("max", F.max, most)) for a in "xyz"]
    return F.struct(*ends)
