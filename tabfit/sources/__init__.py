"""Readers and writers: typed CSV with a bad-row policy, libsvm text, tables."""

from tabfit.sources.csv import CsvRead, read_csv
from tabfit.sources.libsvm import read_libsvm, write_libsvm
from tabfit.sources import schemas

__all__ = ["CsvRead", "read_csv", "read_libsvm", "write_libsvm", "schemas"]
