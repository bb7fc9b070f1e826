"""Datasets: staging, warehouse, reports, metrics, outage model."""
