"""The categorical signal lists the training levels without writing the training rows."""

from panelcast.plans import catalog, warehouse


def test_signal_writes_no_training_rows(spark, data, monkeypatch):
    written = []
    for module in (catalog, warehouse):
        write = module.materialize
        monkeypatch.setattr(module, "materialize", lambda df, name="table", write=write: written.append(name) or write(df, name))
    assert catalog.signal_categorical(spark, data).count() > 0
    assert written == ["facts"]
