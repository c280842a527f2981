"""Writers. Each runs its write and returns what was written as a table."""
