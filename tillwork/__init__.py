"""Retail sales analytics as Spark DataFrame transformations."""

from tillwork.session import build_session, settle, shared_folder, tune

__all__ = ["build_session", "settle", "shared_folder", "tune"]
