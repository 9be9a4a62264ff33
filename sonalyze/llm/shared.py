"""What the operators use of the session: the shared folder, tables in it, and the package that is shipped to workers."""

from sonalyze.shared import cut, discard, freed, n_buckets, remove, scratch, shared_dir, ship, stored

__all__ = ["cut", "discard", "freed", "n_buckets", "remove", "scratch", "shared_dir", "ship", "stored"]
