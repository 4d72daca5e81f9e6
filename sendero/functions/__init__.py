"""Column builders: text normalizers, classification, geography. No Python runs on the executors."""
