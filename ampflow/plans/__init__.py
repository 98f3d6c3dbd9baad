"""Layered models (stage, curated, semantic) and the questions asked of them."""
