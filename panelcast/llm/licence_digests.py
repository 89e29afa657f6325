"""Digests of the canonical forms of whole licence texts, as ``licences.canonical`` gives them.

Fixed values: long public licences, whose wording is not repeated here.  A text with an appendix on
how to apply it is known with and without it, and without the line that closes the terms.  Whoever
changes the canonical form has to make these digests anew.
"""

LICENCE_DIGESTS = [
    ("Apache-2.0", "036b5ff6d47b44974c624da95e5bf0ac7ddfe5030e41dfa7ff8ac0c1daa9f32b"),
    ("Apache-2.0", "f70a2718f78121f2da77cd6afbffffbd668d7c1fd36c85a3ef121e83cb5f48fe"),
    ("Apache-2.0", "6aa661403864282a4d084f1551e8149a5f1a7b5e8b05b6db8e1a8a28d0badc64"),
    ("Artistic-1.0-Perl", "08f1dc258c8f9e175155356aa1dd0dead8cfdec586bc1bb4c8b1452699a91702"),
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
    ("CC-BY-SA-4.0", "e7ab2c95c0a583681fcc0e8ff5768f05516480e7a144b8009451c871267661d1"),
    ("GFDL-1.2", "94541e73869af10ab6bd68a29575eede324e54e7d5237e7386d12444f593af60"),
    ("GFDL-1.3", "a92fdbaeafedd9cbeb812ebbded06ee07e3b1427c81cfc333e682109c594d826"),
    ("GPL-1.0", "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224"),
    ("GPL-1.0", "6375a768fd262bf5281905a9585411d2d0fb4ea15cb08cfcba49f73fedb82abc"),
    ("GPL-1.0", "89f75ffda938e788be38679f9f83e317c2a03398fccf03ee60505d44d1bf9f70"),
    ("GPL-2.0", "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821"),
    ("GPL-2.0", "e1270b653c300290e7c039142bccb8776f9b5d14e8a05bc4e87dc7d1614a3b34"),
    ("GPL-2.0", "6d332dc4c3c5293a73c6c9da402f9bbc970b3bb1eb472f577e00580573469808"),
    ("GPL-2.0", "aa997bc1c3422ccdc7ccabdc6f9aaa9ce2ebeed7be208887d2b13ff901326c75"),
    ("GPL-2.0", "c2eea7a9d82a254e540a96d8107801d93d00bcef2742a78b7e8e8d0c0efcbd1c"),
    ("GPL-2.0", "031ce0347a7bfaa9fea9fb34dc0def0f70d366e9b6aeab50cf9537178d0d9d50"),
    ("GPL-3.0", "eaab5d82fdcca441d83a1913bbf07e4de3a739e190578c0bffde24f84e93bb2a"),
    ("GPL-3.0", "ac6b52d57c0104e687039148f7b8e370e04c9bb5705bb786f8ef814eb65e8636"),
    ("GPL-3.0", "092a7f3b82e6c22949b46388bca99e725b6e756f1c2b1e3f575447fbd44b6191"),
    ("LGPL-2.0", "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908"),
    ("LGPL-2.0", "504542bce5421b0f5a7e63ddb55443ccb300b27a65ba6bfc1370fed16a3af260"),
    ("LGPL-2.0", "430627da7218a92ab4a6d75d5140cdb70ee750be7a53f913299b37e0d1b0eea2"),
    ("LGPL-2.1", "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891"),
    ("LGPL-2.1", "48d2010e70a815a564f914b0c7c1e80d7a6843793348fed3684c957112fe0aa4"),
    ("LGPL-2.1", "bf2f0c6bf1c47b3b1e3cbedeefecddd1e7db21d1919858d45c2f918efaf426df"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "a1b36de49a400e3d3385d5987188db954a084f9876243aa7207cd91de3f24a7b"),
    ("MPL-2.0", "f82071285728ca3ec7685ee9bc4acdae0b8267142a4d20b8f1805eabedb4a98a"),
    ("OFL-1.1", "b80f6498cf31cc02c16942b317f9b5b55be820889a29c0a2c97a9e41a7b4eb07"),
    ("Unicode-3.0", "53113a39b79251016cf92b8348f303cee44e4faee1f232536754abc669dd32c8"),
]
