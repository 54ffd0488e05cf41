"""Personal data in lines written by hand, apart from the generator that the field learns from."""

import pytest

from tabwright.llm.pii import KINDS, Field, all_spans, train

# {kind:...} marks an entity; the lines are read by nobody but this test.
LINES = """
Please reach me at {phone:212 555 0187} after six.
tel {phone:020 7946 0958}
phone: {phone:1234567890}
You may call {phone:(415) 555-2671} today or tomorrow.
Our fax is {phone:415-555-2671}.
mobile {phone:0171 2345678}, office closed on Mondays
ring us on {phone:0161 496 0123} between nine and five
dial {phone:+1 415 555 2671} now
My cell {phone:646.555.0134} is usually off in meetings.
Telephone: {phone:01632 960 983}
For refunds call {phone:800 555 0199} and wait for the tone.
Mum's phone {phone:07700 900123} has no signal there.
contact desk, phone {phone:(020) 7946-0018}
write to {email:jane.doe at example dot com} please
{email:jane [at] example [dot] org}
{email:bob(at)site(dot)de} is the address of the club
mail {email:info (at) museum (dot) net} for group tickets
Send it to {email:sales@example.com}, not to me.
the address {email:max_mustermann [at] firma [dot] de} still works
email {email:anna.k at uni dot org} about the thesis
You can mail {email:press(at)paper.co(dot)uk} until noon.
contact {email:first.last+tag@mail.example.org} or ask at the door
server {ip:10 . 0 . 0 . 12} is down again
the host {ip:192.168.17.4} answered in 3 ms
ip {ip:8 . 8 . 4 . 4} does not answer
address {ip:172.16.254.1} is private
card {card:4111.1111.1111.1111} expires soon
visa {card:4111/1111/1111/1111} was refused
credit card {card:5500 0000 0000 0004} on file
mastercard {card:5105-1051-0510-5100}, name on the back
My card is {card:4012888888881881} and it is blue.
She paid with {card:4222.2222.2222.2220} again
1. 2. 3. 4. and then the answers
We had the meeting at noon dot dot dot and then left.
order 555-123-4567-889 was sent back
on 2024-01-15 at 10:30 in room 12
pages 12 13 14 15 and 16 are missing
version 1.2.34 of the program
invoice 20240115001 is still open
chapter 3. 4. 5. 6. of the book
the score was 21 14 21 18 in the end
at 5 p.m. tomorrow, or at 6. perhaps
between the year 1999 and 2003
ISBN 978-3-16-148410-0 in hard cover
width 1024 height 768 depth 24
a population of 1234567 in the city
look at this. it is good
zip 94105 1234 in the north
She lives at number 12. nobody else does.
part 4711-0815-42 fits the old model
the draw was 3 14 15 92 65 35
section 2.3.4.5.6 says nothing of it
It weighs 12.5 kg, costs 1,250.00 and is 30.5 cm wide.
flight 4502 leaves gate 12 at 18.45 on 03.04.2025
matches ended 3-1, 2-2 and 0-4 that week
serial 4111 1111 1111 1112 on the back plate
the constants 3.14159 and 2.71828
article 12-34-56-78 from the yellow list
track 9400 1000 0000 0000 0000 00 was lost
arrive at 9. dot the letters at home
""".strip().split("\n")


def marked(line):
    """The plain line, and its entities (start, kind, end)."""
    text, spans = "", set()
    while "{" in line:
        before, rest = line.split("{", 1)
        inside, line = rest.split("}", 1)
        kind, entity = inside.split(":", 1)
        text += before
        spans.add((len(text), KINDS.index(kind), len(text) + len(entity)))
        text += entity
    return text + line, spans


@pytest.fixture(scope="module")
def by_kind():
    """Right, found and wanted spans of each kind."""
    field = Field(train())
    counts = {kind: [0, 0, 0] for kind in range(len(KINDS))}
    for line in LINES:
        text, wanted = marked(line)
        base, more = all_spans(text, field)
        found = {*base, *more}
        for kind, row in counts.items():
            own = [{s for s in spans if s[1] == kind} for spans in (found & wanted, found, wanted)]
            for i, spans in enumerate(own):
                row[i] += len(spans)
    return counts


@pytest.mark.parametrize("kind", range(len(KINDS)))
def test_precision_and_recall(by_kind, kind):
    right, found, wanted = by_kind[kind]
    print(f"{KINDS[kind]}: precision {right}/{found}, recall {right}/{wanted}")
    assert right / found >= 0.8 and right / wanted >= 0.8
