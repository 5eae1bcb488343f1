"""Delivery-delay analytics for marketplace orders, written for PySpark."""
