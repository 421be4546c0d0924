"""The named queries of this repository and their SQL counterparts."""
