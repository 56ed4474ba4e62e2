from wardline.sources.io import load, load_table, save, save_with_schema, load_csv, save_csv, nan_to_null

__all__ = ["load", "load_table", "save", "save_with_schema", "load_csv", "save_csv", "nan_to_null"]
