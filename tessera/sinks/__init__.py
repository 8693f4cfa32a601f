from .warehouse import ViolationsFound, Warehouse, upsert_frames

__all__ = ["ViolationsFound", "Warehouse", "upsert_frames"]
